"""Declared schemas of feeds and tables (fixed values: names, types and comments)."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema(columns: str, comments: dict[str, str] | None = None) -> T.StructType:
    """StructType from ``name type, ...`` without needing a session, with column comments."""
    notes = comments or {}
    fields = []
    for part in columns.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, TYPES[kind], True, {"comment": notes[name]} if name in notes else {}))
    return T.StructType(fields)


GPS_PINGS = schema(
    "ping_id string, vehicle_id string, vehicle_type string, site_name string, latitude double, longitude double, "
    "speed_kmh double, heading_degrees double, engine_on boolean, fuel_level_pct double, ping_timestamp timestamp, "
    "batch_id string",
    {"speed_kmh": "ground speed, raw", "engine_on": "ignition state"},
)
DELIVERY_RECEIPTS = schema(
    "delivery_id string, supplier string, material string, quantity int, unit string, unit_price double, total_cost double, "
    "destination_site string, warehouse_origin string, po_number string, delivery_date string, received_by string, "
    "condition string, batch_id string",
    {"condition": "good, partial, damaged or missing"},
)
WAREHOUSE_STOCK = schema(
    "warehouse_id string, warehouse_name string, region string, material string, on_hand_qty int, reorder_point int, "
    "unit string, below_reorder boolean, last_replenished string, snapshot_timestamp string, batch_id string"
)
SUPPLIER_INVOICES = schema(
    "invoice_id string, supplier string, po_number string, invoice_date string, due_date string, line_items int, "
    "subtotal_aud double, gst_aud double, total_aud double, currency string, payment_status string, site string, "
    "batch_id string",
    {"gst_aud": "goods and services tax"},
)

# Feed name -> (schema, file format).
FEEDS: dict[str, tuple[T.StructType, str]] = {
    "gps_pings": (GPS_PINGS, "csv"),
    "delivery_receipts": (DELIVERY_RECEIPTS, "json"),
    "warehouse_stock": (WAREHOUSE_STOCK, "csv"),
    "supplier_invoices": (SUPPLIER_INVOICES, "csv"),
}

FINANCIALS = schema(
    "project_id string, project_name string, division string, client string, project_type string, state string, "
    "budget_aud double, actual_cost_aud double, earned_value_aud double, planned_value_aud double, "
    "cost_variance_pct double, spi double, cpi double, status string, start_date date, planned_completion date, "
    "reporting_period date, project_manager string",
    {"spi": "schedule performance index", "cpi": "cost performance index"},
)
TELEMETRY = schema(
    "equipment_id string, equipment_type string, site_name string, division string, engine_temp_celsius double, "
    "fuel_level_pct double, operating_hours int, maintenance_due_date date, status string, reading_timestamp timestamp"
)
INCIDENTS = schema(
    "incident_id string, incident_date date, site_name string, division string, incident_type string, severity string, "
    "description string, injuries int, lost_time_days double, root_cause string, corrective_action string, status string"
)
MATERIALS = schema(
    "material_id string, material_name string, category string, supplier string, unit_price_aud double, unit string, "
    "lead_time_days int, last_order_date date, last_order_qty double, price_trend string, availability string"
)
