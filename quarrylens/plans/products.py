"""Layered data products by name, each a builder over the registry."""

from __future__ import annotations

from datetime import date

from quarrylens.plans import gold, rollups, silver
from quarrylens.sources.derived import DELIVERY_ORDER

# Reporting days of the order-based and the event-based tables.
ORDERS_AS_OF = date(2001, 7, 1)
EVENTS_AS_OF = date(2024, 1, 30)
LOADED = ("_ingested_at",)
DERIVED_KEYS = ("_partkey", "_suppkey", "_price", "_discount", "_tax")

PRODUCTS = {
    "silver_fleet_positions": lambda t: silver.fleet_positions(t["bronze_gps_pings"], LOADED),
    "silver_deliveries": lambda t: silver.deliveries(t["bronze_delivery_receipts"], DELIVERY_ORDER).drop(*DERIVED_KEYS),
    "silver_inventory": lambda t: silver.inventory_snapshots(t["bronze_warehouse_stock"], ORDERS_AS_OF, LOADED),
    "silver_invoices": lambda t: silver.invoices(t["bronze_supplier_invoices"], ORDERS_AS_OF, LOADED),
    "gold_fleet_utilisation_daily": lambda t: gold.fleet_utilisation_daily(t["silver_fleet_positions"]),
    "gold_delivery_performance": lambda t: gold.delivery_performance(t["silver_deliveries"]),
    "gold_inventory_health": lambda t: gold.inventory_health(t["silver_inventory"]),
    "gold_invoice_aging": lambda t: gold.invoice_aging(t["silver_invoices"]),
    "gold_site_operations_summary": lambda t: gold.site_operations_summary(
        t["silver_fleet_positions"], t["silver_deliveries"], t["silver_invoices"]
    ),
    "gold_supplier_scorecard": lambda t: gold.supplier_scorecard(t["silver_deliveries"], t["silver_invoices"]),
    "project_kpis": lambda t: rollups.project_kpis(t["financials"]),
    "safety_kpis": lambda t: rollups.safety_kpis(t["incidents"]),
    "fleet_kpis": lambda t: rollups.fleet_kpis(t["telemetry"], t["maintenance_log"]),
    "division_summary": lambda t: rollups.division_summary(
        t["financials"], t["telemetry"], t["maintenance_log"], t["incidents"], t["emissions"]
    ),
    "monthly_kpis": lambda t: rollups.monthly_kpis(t["financials"], t["incidents"], t["inspections"], t["emissions"]),
    "exec_scorecard": lambda t: rollups.exec_scorecard(t["supplier_lines"], t["supplier_contracts"]),
    "project_risk_matrix": lambda t: rollups.project_risk_matrix(
        t["financials"], t["milestones"], t["incidents"], t["project_materials"]
    ),
    "financials_by_division": lambda t: rollups.financials_by_division(t["financials"]),
    "safety_summary": lambda t: rollups.safety_summary(t["incidents"]),
    "equipment_status": lambda t: rollups.equipment_status(t["telemetry"], t["maintenance_log"]),
    "procurement_analytics": lambda t: rollups.procurement_analytics(t["materials"]),
    "workforce_utilisation": lambda t: rollups.workforce_utilisation(t["timesheets"]),
    "compliance_dashboard": lambda t: rollups.compliance_dashboard(t["emissions"]),
}
