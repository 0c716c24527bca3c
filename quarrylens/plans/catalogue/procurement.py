"""Materials, suppliers, stock and invoices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import dec, pct, ratio, rnd
from quarrylens.functions.predicates import domain_rank
from quarrylens.functions.vocab import AVAILABILITY, STOCK_STATUSES
from quarrylens.operators.partitions import dealt
from quarrylens.operators.windows import arg_max, concentration, ranked, top_k
from quarrylens.plans import gold
from quarrylens.plans.catalogue.base import query
from quarrylens.plans.rollups import MONEY
from quarrylens.sources.tables import Tables

AS_OF = date(2001, 7, 1)
CATEGORY = "PROMO"


def _spend() -> Column:
    return rules.est_spend("unit_price_aud", "last_order_qty")


def _sum_spend() -> Column:
    return F.sum(_spend()).cast("double")


def _rising() -> Column:
    return F.col("price_trend") == "increasing"


def _risky() -> Column:
    return rules.supply_risk("availability")


def _lead(places: int = 0) -> Column:
    return rnd(ratio(aggs.total_int("lead_time_days"), F.count("lead_time_days")), places)


def _price(places: int = 2) -> Column:
    return aggs.avg_rounded("unit_price_aud", places)


@query("q_pr_01", "Materials with rising prices")
def rising_prices(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .filter(_rising())
        .select("material_name", "category", "supplier", "unit_price_aud", "unit", "availability")
        .orderBy(F.desc("unit_price_aud"), "material_name", "supplier")
    )


@query("q_pr_02", "Limited or out of stock materials")
def supply_risk(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .filter(_risky())
        .select("material_name", "category", "supplier", "unit_price_aud", "lead_time_days", "price_trend", "availability")
        .orderBy("availability", F.desc("lead_time_days"), "material_name", "supplier")
    )


@query("q_pr_03", "Average price and lead time by category")
def by_category(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .groupBy("category")
        .agg(aggs.n_rows().alias("materials"), _price().alias("avg_price"), _lead().alias("avg_lead_days"))
        .orderBy(F.desc("avg_price"), "category")
    )


@query("q_pr_04", "Suppliers of one category")
def category_suppliers(t: Tables, category: str = CATEGORY) -> DataFrame:
    return (
        t["materials"]
        .filter(F.col("category") == category)
        .select("material_name", "supplier", "unit_price_aud", "unit", "lead_time_days", "price_trend", "availability")
        .orderBy(F.desc("unit_price_aud"), "material_name", "supplier")
    )


@query("q_pr_05", "Long lead times")
def long_lead(t: Tables, days: int = 30) -> DataFrame:
    return (
        t["materials"]
        .filter(F.col("lead_time_days") > days)
        .select("material_name", "category", "supplier", "lead_time_days", "availability", "price_trend")
        .orderBy(F.desc("lead_time_days"), "material_name", "supplier")
    )


@query("q_pr_06", "Largest last orders")
def largest_orders(t: Tables, k: int = 20) -> DataFrame:
    rows = t["materials"].select(
        "material_id",
        "material_name",
        "category",
        "supplier",
        "unit_price_aud",
        "unit",
        "last_order_qty",
        _spend().cast("double").alias("estimated_spend_aud"),
    )
    return top_k(rows, [F.desc("estimated_spend_aud")], k, ["material_id"]).drop("material_id")


@query("q_pr_07", "Spend by supplier and category")
def spend_by_supplier(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .groupBy("supplier", "category")
        .agg(
            aggs.n_rows().alias("orders"),
            rnd(aggs.total("total_cost_aud"), 2).alias("total_spend_aud"),
            _price().alias("avg_unit_price"),
            _lead().alias("avg_lead_days"),
        )
        .orderBy(F.desc("total_spend_aud"), "supplier", "category")
    )


@query("q_pr_08", "Rising price and short supply")
def rising_and_short(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .filter(_rising() & _risky())
        .select(
            "material_name", "category", "supplier", "unit_price_aud", "unit", "lead_time_days", "price_trend", "availability"
        )
        .orderBy(F.desc("unit_price_aud"), "material_name", "supplier")
    )


@query("q_pr_09", "Supplier scorecard ranking")
def scorecard_ranking(t: Tables) -> DataFrame:
    return (
        t["gold_supplier_scorecard"]
        .select(
            "supplier",
            "supplier_score",
            "supplier_tier",
            "deliveries",
            "delivery_spend_aud",
            "delivery_damage_rate_pct",
            "cost_discrepancy_rate_pct",
            "invoices",
            "invoiced_aud",
            "invoice_overdue_pct",
        )
        .orderBy(F.desc("supplier_score"), "supplier")
    )


@query("q_pr_10", "Price comparison across suppliers in a category")
def price_comparison(t: Tables, category: str = CATEGORY) -> DataFrame:
    return (
        t["materials"]
        .filter(F.col("category") == category)
        .groupBy("supplier", "material_name", "price_trend")
        .agg(
            _price().alias("avg_price_aud"),
            rnd(F.min("unit_price_aud"), 2).alias("min_price"),
            rnd(F.max("unit_price_aud"), 2).alias("max_price"),
            aggs.n_rows().alias("orders"),
        )
        .orderBy("avg_price_aud", "supplier", "material_name")
    )


@query("q_pr_11", "Warehouses short of stock")
def short_stock(t: Tables, statuses: Sequence[str] = STOCK_STATUSES[:2]) -> DataFrame:
    return (
        t["gold_inventory_health"]
        .filter(F.col("stock_status").isin(*statuses))
        .select(
            "warehouse_name", "region", "material", "on_hand_qty", "reorder_point", "stock_status", "days_since_replenishment"
        )
        .orderBy(domain_rank("stock_status", STOCK_STATUSES), F.desc("days_since_replenishment"), "warehouse_name", "material")
    )


@query("q_pr_12", "Procurement spend by project")
def spend_by_project(t: Tables, safe: bool = False) -> DataFrame:
    """Published form: each order counts once per snapshot of its project."""
    names = t["financials"].groupBy("project_id", "project_name", "division").agg(aggs.n_rows().alias("_snapshots"))
    times = F.lit(1).cast("bigint") if safe else F.col("_snapshots")
    orders = t["project_materials"].filter(F.col("project_id").isNotNull()).drop("division")
    return (
        dealt(orders, "project_id")
        .join(names, "project_id")
        .groupBy("project_name", "division")
        .agg(
            F.sum(times).alias("orders"),
            rnd(F.sum(dec("total_cost_aud") * times.cast("decimal(9,0)")), 2).alias("procurement_spend_aud"),
            aggs.distinct("supplier").alias("unique_suppliers"),
            aggs.distinct("category").alias("material_categories"),
        )
        .orderBy(F.desc("procurement_spend_aud"), "project_name")
    )


@query("q_pr_12_safe", "Procurement spend by project, each order once")
def spend_by_project_safe(t: Tables) -> DataFrame:
    return spend_by_project(t, safe=True)


@query("q_pr_13", "Procurement against budget by division")
def spend_against_budget(t: Tables) -> DataFrame:
    bought = t["materials"].groupBy("division").agg(aggs.total("total_cost_aud").alias("_cost"))
    budget = t["financials"].groupBy("division").agg(aggs.total("budget_aud", MONEY).alias("_budget"))
    cost = F.coalesce("_cost", F.lit(0.0))
    return (
        budget.join(bought, "division", "left")
        .select(
            "division",
            rnd(F.col("_budget") / 1e6, 1).alias("total_budget_m"),
            rnd(cost / 1e6, 2).alias("procurement_m"),
            rnd(ratio(cost * 100.0, "_budget"), 1).alias("procurement_pct_of_budget"),
        )
        .orderBy(F.desc("procurement_m"), "division")
    )


@query("q_pr_14", "Suppliers at risk and their issues")
def suppliers_at_risk(t: Tables, tier: str = "D - Review Required") -> DataFrame:
    return (
        t["gold_supplier_scorecard"]
        .filter(F.col("supplier_tier") == tier)
        .select(
            "supplier",
            "supplier_score",
            "supplier_tier",
            "delivery_damage_rate_pct",
            "cost_discrepancy_rate_pct",
            "disputed_invoices",
            "invoice_overdue_pct",
        )
        .orderBy("supplier_score", "supplier")
    )


@query("q_pr_15", "Stock status by region and warehouse")
def stock_by_region(t: Tables) -> DataFrame:
    return (
        t["gold_inventory_health"]
        .groupBy("region", "warehouse_name")
        .agg(*aggs.status_counts("stock_status", STOCK_STATUSES, "_items"))
        .orderBy(F.desc("out_of_stock_items"), "region", "warehouse_name")
    )


@query("q_pr_16", "Procurement benchmarks")
def procurement_benchmarks(t: Tables, category: str = CATEGORY) -> DataFrame:
    mine = F.col("category") == category
    lead = F.when(mine, F.col("lead_time_days"))
    return t["materials"].agg(
        rnd(aggs.total("unit_price_aud"), 2).alias("total_unit_prices"),
        rnd(ratio(aggs.total_int(lead), F.count(lead)), 0).alias("avg_lead_days_of_category"),
    )


@query("q_pr_16_tier", "Number of suppliers per tier")
def suppliers_per_tier(t: Tables) -> DataFrame:
    return t["gold_supplier_scorecard"].groupBy("supplier_tier").agg(aggs.n_rows().alias("suppliers"))


@query("q_pr_16_warehouse", "Warehouse with the most short items")
def worst_warehouse(t: Tables, status: str = "below_reorder") -> DataFrame:
    per = (
        t["gold_inventory_health"]
        .filter(F.col("stock_status") == status)
        .groupBy("warehouse_name")
        .agg(aggs.n_rows().alias("cnt"))
    )
    return arg_max(per, "cnt", "warehouse_name")


@query("q_pr_17", "Estimated spend by category")
def estimated_spend(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .groupBy("category")
        .agg(
            aggs.n_rows().alias("material_count"),
            _sum_spend().alias("estimated_spend_aud"),
            _price().alias("avg_unit_price"),
            _lead().alias("avg_lead_time_days"),
            aggs.count_where(_rising()).alias("rising_price_count"),
            aggs.count_where(_risky()).alias("supply_risk_count"),
        )
        .orderBy(F.desc("estimated_spend_aud"), "category")
    )


@query("q_pr_18", "Supplier price, lead time and availability card")
def supplier_card(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .groupBy("supplier")
        .agg(
            aggs.n_rows().alias("materials_supplied"),
            _price().alias("avg_unit_price"),
            _lead().alias("avg_lead_time_days"),
            _sum_spend().alias("total_estimated_spend"),
            aggs.count_where(_rising()).alias("rising_prices"),
            aggs.count_where(F.col("availability") == "good").alias("in_stock_count"),
            aggs.count_where(_risky()).alias("risk_items"),
        )
        .orderBy(F.desc("total_estimated_spend"), "supplier")
    )


@query("q_pr_19", "Risk materials with last order value")
def risk_materials(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .filter(_risky())
        .select(
            "material_id",
            "material_name",
            "category",
            "supplier",
            "unit_price_aud",
            "unit",
            "lead_time_days",
            "availability",
            "price_trend",
            "last_order_date",
            "last_order_qty",
            _spend().cast("double").alias("last_order_value_aud"),
        )
        .orderBy(domain_rank("availability", AVAILABILITY), F.desc("last_order_value_aud"), "material_id")
    )


@query("q_pr_20", "Supplier concentration in a category")
def supplier_concentration(t: Tables, threshold: float = 30.0, group: str = "category", member: str = "supplier") -> DataFrame:
    return (
        concentration(t["materials"], group, member, threshold, _sum_spend().alias("supplier_spend_in_category"))
        .select(
            group,
            member,
            F.col("n_rows").alias("material_count"),
            rnd("share_pct", 1).alias("pct_of_category"),
            "supplier_spend_in_category",
        )
        .orderBy(group, F.desc("pct_of_category"), member)
    )


@query("q_pr_20_division", "Division concentration in a category")
def division_concentration(t: Tables) -> DataFrame:
    return supplier_concentration(t, threshold=20.0, member="division")


@query("q_pr_20_site", "Supplier site concentration in a category")
def site_concentration(t: Tables) -> DataFrame:
    return supplier_concentration(t, threshold=4.0, member="site_name")


@query("q_pr_21", "Long lead and rising price")
def long_lead_rising(t: Tables, days: int = 30) -> DataFrame:
    return (
        t["materials"]
        .filter((F.col("lead_time_days") > days) & _rising())
        .select(
            "material_id",
            "material_name",
            "category",
            "supplier",
            "unit_price_aud",
            "unit",
            "lead_time_days",
            "price_trend",
            "availability",
            "last_order_date",
        )
        .orderBy(F.desc("lead_time_days"), "material_id")
    )


@query("q_pr_22", "Executive scorecard, riskiest first")
def exec_by_risk(t: Tables) -> DataFrame:
    return t["exec_scorecard"].orderBy("quality_score", F.desc("total_spend_aud"), "supplier_name", "category")


@query("q_pr_22_expiring", "Suppliers with expiring contracts")
def expiring(t: Tables) -> DataFrame:
    return t["exec_scorecard"].filter(rules.contract_expiring("contract_status")).orderBy(
        F.desc("total_spend_aud"), "supplier_name", "category"
    )


@query("q_pr_22_review", "Low quality, or contract under review or expiring")
def under_review(t: Tables, below: float = 3.0) -> DataFrame:
    wanted = F.col("contract_status").isin("Under Review", "Expiring Soon") | (F.col("quality_score") < below)
    return t["exec_scorecard"].filter(wanted).orderBy(F.desc("total_spend_aud"), "supplier_name", "category")


@query("q_pr_23", "Procurement exposure")
def exposure(t: Tables, days: int = 30) -> DataFrame:
    return (
        t["materials"]
        .filter(_risky() | (_rising() & (F.col("lead_time_days") > days)))
        .select(
            "category",
            "material_name",
            "supplier",
            "unit_price_aud",
            "lead_time_days",
            "price_trend",
            "availability",
            _spend().cast("double").alias("est_spend_aud"),
        )
        .orderBy(F.desc("est_spend_aud"), "material_name", "supplier")
    )


def _risk_items(t: Tables) -> DataFrame:
    return (
        t["materials"]
        .filter(_risky())
        .groupBy(F.col("supplier").alias("supplier_name"), "category")
        .agg(aggs.n_rows().alias("risk_materials"), _sum_spend().alias("risk_spend_aud"))
    )


@query("q_pr_24", "Low quality score and supply issues")
def low_quality_and_short(t: Tables, below: float = 3.0) -> DataFrame:
    low = t["exec_scorecard"].filter(F.col("quality_score") < below)
    return low.join(_risk_items(t), ["supplier_name", "category"]).select(
        "supplier_name", "category", "quality_score", "contract_status", "risk_materials", "risk_spend_aud"
    )


@query("q_pr_25", "Cost estimate of a bill of materials against market prices")
def cost_estimate(t: Tables) -> DataFrame:
    """Needs ``bill`` (material_id, qty) and ``market_prices`` (category, market_price_aud) in the registry."""
    internal = t["materials"].select("material_id", "material_name", "category", "supplier", "unit_price_aud")
    lines = t["bill"].join(internal, "material_id").join(t["market_prices"], "category", "left")
    cost = dec("unit_price_aud") * F.col("qty").cast("decimal(12,0)")
    market = dec("market_price_aud") * F.col("qty").cast("decimal(12,0)")
    return lines.select(
        "material_id",
        "material_name",
        "supplier",
        "qty",
        "unit_price_aud",
        "market_price_aud",
        cost.cast("double").alias("internal_cost_aud"),
        market.cast("double").alias("market_cost_aud"),
        (F.col("unit_price_aud") > F.col("market_price_aud")).alias("overpaying"),
    )


@query("q_pr_26", "Materials not ordered for a while")
def stale_orders(t: Tables, as_of: date = AS_OF, days: int = 90) -> DataFrame:
    return (
        t["materials"]
        .filter(F.col("last_order_date") < F.lit(as_of - timedelta(days=days)))
        .select("material_id", "material_name", "supplier", "last_order_date")
    )


@query("q_pr_27", "Invoice aging summary")
def aging_summary(t: Tables) -> DataFrame:
    return t["gold_invoice_aging"].groupBy("aging_bucket", "payment_risk").agg(
        aggs.n_rows().alias("invoices"), aggs.total("total_aud", 3).alias("total_aud")
    )


@query("q_pr_27_overdue", "Overdue invoices by supplier")
def overdue_by_supplier(t: Tables) -> DataFrame:
    return (
        t["gold_invoice_aging"]
        .filter(F.col("is_overdue"))
        .groupBy("supplier")
        .agg(aggs.n_rows().alias("invoices"), aggs.total("total_aud", 3).alias("overdue_aud"))
    )


@query("q_pr_27_damage", "Damage rate by supplier")
def damage_rate(t: Tables) -> DataFrame:
    return gold.damage_by_supplier(t["silver_deliveries"])


@query("q_pr_28", "Suppliers ranked by rising-price materials")
def rising_by_supplier(t: Tables) -> DataFrame:
    per = t["materials"].groupBy("supplier").agg(
        aggs.count_where(_rising()).alias("rising_materials"), aggs.n_rows().alias("materials")
    )
    return ranked(per, "rising_materials", out="rising_rank")


@query("q_pr_29", "Same material, best price and lead time across suppliers")
def best_offer(t: Tables) -> DataFrame:
    """Best values are aggregates per material, so a material with very many suppliers is combined early."""
    best = t["materials"].groupBy("material_name", "category").agg(
        aggs.n_rows().alias("offers"),
        F.min("unit_price_aud").alias("best_price"),
        F.max("unit_price_aud").alias("worst_price"),
        F.min("lead_time_days").alias("best_lead_days"),
        F.min_by("supplier", F.struct("unit_price_aud", "lead_time_days", "supplier")).alias("best_supplier"),
    )
    return best.filter(F.col("offers") > 1)


@query("q_pr_30", "Categories by longest lead time and supplier count")
def category_card(t: Tables) -> DataFrame:
    return t["materials"].groupBy("category").agg(
        F.max("lead_time_days").alias("longest_lead_days"),
        aggs.distinct("supplier").alias("suppliers"),
        F.max("unit_price_aud").alias("highest_price"),
    )


@query("q_pr_30_top", "Most expensive materials")
def most_expensive(t: Tables, k: int = 10) -> DataFrame:
    rows = t["materials"].select("material_id", "material_name", "category", "supplier", "unit_price_aud")
    return top_k(rows, [F.desc("unit_price_aud")], k, ["material_id"])


@query("q_pr_31", "Expiring contracts with high spend")
def expiring_high_spend(t: Tables, above: float = 1_000_000.0) -> DataFrame:
    return t["exec_scorecard"].filter(rules.contract_expiring("contract_status") & (F.col("total_spend_aud") > above))


@query("q_pr_31_rank", "Suppliers ranked by quality")
def quality_rank(t: Tables) -> DataFrame:
    per = t["exec_scorecard"].groupBy("supplier_name").agg(aggs.avg_rounded("quality_score", 2).alias("avg_quality"))
    return ranked(per, "avg_quality", out="quality_rank")


@query("q_pr_32", "High spend and supply-risk materials")
def high_spend_and_short(t: Tables, above: float = 1_000_000.0) -> DataFrame:
    big = t["exec_scorecard"].filter(F.col("total_spend_aud") > above)
    return big.join(_risk_items(t), ["supplier_name", "category"]).select(
        "supplier_name", "category", "total_spend_aud", "quality_score", "risk_materials", "risk_spend_aud"
    )


@query("q_pr_33", "Projects with the largest procurement spend")
def top_spending_projects(t: Tables, k: int = 5) -> DataFrame:
    per = t["project_materials"].groupBy("project_id").agg(
        aggs.total("total_cost_aud").alias("spend_aud"), aggs.n_rows().alias("orders")
    )
    return top_k(per, [F.desc("spend_aud")], k, ["project_id"])


@query("q_pr_33_category", "Spend on one category")
def category_spend(t: Tables, category: str = CATEGORY) -> DataFrame:
    return t["materials"].filter(F.col("category") == category).agg(
        aggs.total("total_cost_aud").alias("spend_aud"), aggs.n_rows().alias("materials")
    )


@query("q_pr_34", "Suppliers by lead band, supply and procurement risk")
def risk_bands(t: Tables) -> DataFrame:
    return t["materials"].groupBy(
        rules.lead_band("lead_time_days").alias("lead_band"),
        _risky().alias("supply_risk"),
        rules.procurement_risk("price_trend", "availability", "lead_time_days").alias("procurement_risk"),
    ).agg(aggs.n_rows().alias("materials"), rnd(pct(aggs.count_where(_rising()), aggs.n_rows()), 1).alias("rising_pct"))


