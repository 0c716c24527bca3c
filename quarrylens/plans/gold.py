"""Data products built on the clean layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs
from quarrylens.functions.numeric import Colish, pct, rnd
from quarrylens.functions.predicates import label
from quarrylens.functions.vocab import TIERS
from quarrylens.operators.joins import full_chain, full_on
from quarrylens.operators.latest import dedup_latest

# Scale of the measures' decimal form.
COST = 4
TOTAL = 3


def fleet_utilisation_daily(positions: DataFrame) -> DataFrame:
    moving, idle = F.col("is_moving"), F.col("is_idling")
    return positions.groupBy(
        F.to_date("ping_timestamp").alias("report_date"), "vehicle_id", "vehicle_type", "site_name"
    ).agg(
        aggs.n_rows().alias("total_pings"),
        aggs.count_where(moving).alias("moving_pings"),
        aggs.count_where(idle).alias("idling_pings"),
        aggs.count_where(~F.col("engine_on")).alias("off_pings"),
        aggs.avg_rounded("speed_kmh", 1).alias("avg_speed_kmh"),
        rnd(F.max("speed_kmh"), 1).alias("max_speed_kmh"),
        aggs.avg_rounded("fuel_level_pct", 1).alias("avg_fuel_pct"),
        rnd(F.min("fuel_level_pct"), 1).alias("min_fuel_pct"),
        aggs.rate_pct(moving).alias("utilisation_pct"),
        aggs.rate_pct(idle).alias("idle_pct"),
    )


def delivery_performance(deliveries: DataFrame, approx: bool = False) -> DataFrame:
    return deliveries.groupBy("supplier", "destination_site").agg(
        aggs.n_rows().alias("total_deliveries"),
        aggs.total("total_cost", COST).alias("total_spend_aud"),
        aggs.avg_rounded("total_cost", 2, COST).alias("avg_delivery_cost_aud"),
        aggs.count_where(F.col("is_damaged")).alias("damaged_deliveries"),
        aggs.rate_pct(F.col("is_damaged")).alias("damage_rate_pct"),
        aggs.count_where(~F.col("cost_validated")).alias("cost_discrepancies"),
        aggs.distinct("material", approx).alias("unique_materials"),
        aggs.distinct("po_number", approx).alias("unique_pos"),
    )


def inventory_health(snapshots: DataFrame, order: Sequence[Colish] = ("snapshot_timestamp", "batch_id")) -> DataFrame:
    return dedup_latest(snapshots, ["warehouse_id", "material"], order)


def invoice_aging(invoices: DataFrame) -> DataFrame:
    days, status = F.col("days_until_due"), F.col("payment_status")
    bucket = label(
        [
            (status.isin("paid", "approved"), "settled"),
            (days > 30, "not_yet_due"),
            (days.between(15, 30), "due_soon"),
            (days.between(0, 14), "due_imminent"),
            (days.between(-30, -1), "overdue_30"),
            (days.between(-60, -31), "overdue_60"),
        ],
        "overdue_90_plus",
    )
    risk = label(
        [
            (status == "disputed", "high"),
            (F.col("is_overdue") & (days < -30), "high"),
            (F.col("is_overdue"), "medium"),
            (days < 7, "medium"),
        ],
        "low",
    )
    return invoices.select(
        "invoice_id",
        "supplier",
        "site",
        "invoice_date",
        "due_date",
        "total_aud",
        "payment_status",
        "days_until_due",
        "is_overdue",
        bucket.alias("aging_bucket"),
        risk.alias("payment_risk"),
    )


def site_operations_summary(positions: DataFrame, deliveries: DataFrame, invoices: DataFrame) -> DataFrame:
    """Three per-site aggregates; only those are joined."""
    fleet = positions.groupBy("site_name").agg(
        aggs.distinct("vehicle_id").alias("active_vehicles"),
        aggs.rate_pct(F.col("is_moving")).alias("fleet_utilisation_pct"),
        aggs.avg_rounded("fuel_level_pct", 1).alias("avg_fuel_level"),
    )
    goods = deliveries.groupBy(F.col("destination_site").alias("site_name")).agg(
        aggs.n_rows().alias("total_deliveries"),
        aggs.total("total_cost", COST).alias("delivery_spend_aud"),
        aggs.count_where(F.col("is_damaged")).alias("damaged_count"),
        aggs.distinct("supplier").alias("active_suppliers"),
    )
    overdue = F.col("is_overdue")
    bills = invoices.groupBy(F.col("site").alias("site_name")).agg(
        aggs.total("total_aud", TOTAL).alias("total_invoiced_aud"),
        F.sum(F.when(overdue, F.col("total_aud").cast("decimal(18,3)")).otherwise(0)).cast("double").alias("overdue_amount_aud"),
        aggs.count_where(F.col("payment_status") == "disputed").alias("disputed_invoices"),
    )
    return full_chain([fleet, goods, bills], "site_name")


def supplier_scorecard(deliveries: DataFrame, invoices: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    """Score from 100 down: 2 per damage %, 1.5 per discrepancy %, 1 per overdue %, 5 per dispute."""
    goods = deliveries.groupBy("supplier").agg(
        aggs.n_rows().alias("deliveries"),
        aggs.total("total_cost", COST).alias("delivery_spend_aud"),
        aggs.rate_pct(F.col("is_damaged")).alias("delivery_damage_rate_pct"),
        aggs.rate_pct(~F.col("cost_validated")).alias("cost_discrepancy_rate_pct"),
        aggs.distinct("destination_site").alias("sites_served"),
    )
    bills = invoices.groupBy("supplier").agg(
        aggs.n_rows().alias("invoices"),
        aggs.total("total_aud", TOTAL).alias("invoiced_aud"),
        aggs.count_where(F.col("payment_status") == "disputed").alias("disputed_invoices"),
        aggs.rate_pct(F.col("is_overdue")).alias("invoice_overdue_pct"),
    )
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    score = (
        F.lit(100.0)
        - zero("delivery_damage_rate_pct") * 2.0
        - zero("cost_discrepancy_rate_pct") * 1.5
        - zero("invoice_overdue_pct")
        - zero("disputed_invoices") * 5.0
    )
    best, good, fair, poor = tiers
    return (
        full_on(goods, bills, ["supplier"])
        .withColumn("_score", score)
        .withColumn("supplier_score", rnd("_score", 1))
        .withColumn(
            "supplier_tier",
            label([(F.col("_score") >= 90, best), (F.col("_score") >= 75, good), (F.col("_score") >= 50, fair)], poor),
        )
        .drop("_score")
    )


def damage_by_supplier(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("supplier").agg(
        aggs.n_rows().alias("deliveries"), rnd(pct(aggs.count_where(F.col("is_damaged")), aggs.n_rows()), 1).alias("damage_rate_pct")
    )
