"""Clean layer: one function per feed, raw frame in, clean frame out.

``as_of`` replaces the clock, so a rerun gives the same rows.  Processing timestamps are
added by the sink, not here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, clamp
from quarrylens.functions.predicates import default_null, in_bbox, label, to_date_safe, to_ts_safe
from quarrylens.functions.vocab import STOCK_STATUSES
from quarrylens.operators.latest import dedup_latest, total_order

# The continent the sites are on (south, north, west, east) and the speed limits.
BBOX = (-45.0, -10.0, 110.0, 155.0)
SPEED_RANGE = (0.0, 120.0)
INGEST_META = ("_ingested_at", "_source_file")


def fleet_positions(
    pings: DataFrame,
    order: Sequence[Colish],
    bbox: tuple[float, float, float, float] = BBOX,
    moving_above: float = 1.0,
) -> DataFrame:
    """One valid ping per id, speed limited, with moving / idling flags."""
    newest = dedup_latest(pings, ["ping_id"], total_order(pings, order))
    speed = F.col("speed_kmh")
    return (
        newest.filter(in_bbox("latitude", "longitude", *bbox))
        .withColumns({"speed_kmh": clamp(speed, *SPEED_RANGE), "ping_timestamp": to_ts_safe("ping_timestamp")})
        .withColumns({"is_moving": speed > moving_above, "is_idling": F.col("engine_on") & (speed <= moving_above)})
        .drop(*INGEST_META)
    )


def deliveries(
    receipts: DataFrame,
    order: Sequence[Colish],
    tolerance_pct: float = 1.0,
    basis: str = "order",
) -> DataFrame:
    """One receipt per delivery with cost check and damage flag.

    ``basis='order'`` compares the total with quantity x unit price;
    ``basis='category'`` compares the unit price with the material's average.
    """
    newest = dedup_latest(receipts, ["delivery_id"], total_order(receipts, order)).withColumn("delivery_date", to_date_safe("delivery_date"))
    if basis == "category":
        typical = newest.groupBy("material").agg(
            F.try_divide(F.sum(F.col("unit_price").cast("decimal(18,4)")).cast("double"), F.count("unit_price")).alias("_expected")
        )
        newest, actual = newest.join(typical, "material", "left"), F.col("unit_price")
    else:
        newest = newest.withColumn("_expected", F.col("quantity") * F.col("unit_price"))
        actual = F.col("total_cost")
    expected = F.col("_expected")
    off = F.when(expected > 0, F.abs(actual - expected) / expected * 100).otherwise(F.lit(0.0))
    return (
        newest.withColumn("cost_variance_pct", off)
        .withColumns(
            {
                "cost_validated": F.col("cost_variance_pct") < tolerance_pct,
                "condition": default_null("condition", "unknown"),
            }
        )
        .withColumn("is_damaged", F.col("condition").isin("damaged", "partial"))
        .drop("_expected", *INGEST_META)
    )


def inventory_snapshots(
    stock: DataFrame,
    as_of: date,
    order: Sequence[Colish],
    labels: Sequence[str] = STOCK_STATUSES,
    overstock_factor: int = 3,
) -> DataFrame:
    """One row per warehouse, material and batch; ``labels`` are empty, low, fine, too much."""
    empty, low, fine, too_much = labels
    newest = dedup_latest(stock, ["warehouse_id", "material", "batch_id"], total_order(stock, order))
    on_hand = F.col("on_hand_qty")
    return (
        newest.withColumns(
            {
                "last_replenished": to_date_safe("last_replenished"),
                "snapshot_timestamp": to_ts_safe("snapshot_timestamp"),
                "on_hand_qty": F.when(on_hand < 0, F.lit(0)).otherwise(on_hand),
            }
        )
        .withColumns(
            {
                "stock_status": label(
                    [
                        (on_hand == 0, empty),
                        (F.col("below_reorder"), low),
                        (on_hand > F.col("reorder_point") * overstock_factor, too_much),
                    ],
                    fine,
                ),
                "days_since_replenishment": F.datediff(F.lit(as_of), F.col("last_replenished")),
            }
        )
        .drop(*INGEST_META)
    )


def invoices(bills: DataFrame, as_of: date, order: Sequence[Colish], gst_rate: float = 0.1) -> DataFrame:
    """One row per invoice with tax check and days to the due date."""
    newest = dedup_latest(bills, ["invoice_id"], total_order(bills, order))
    due = F.col("due_date")
    return (
        newest.withColumns({"invoice_date": to_date_safe("invoice_date"), "due_date": to_date_safe("due_date")})
        .withColumns(
            {
                "gst_validated": F.abs(F.col("gst_aud") - F.col("subtotal_aud") * gst_rate) < 1.0,
                "is_overdue": (F.col("payment_status") == "pending") & (due < F.lit(as_of)),
                "days_until_due": F.datediff(due, F.lit(as_of)),
            }
        )
        .drop(*INGEST_META)
    )
