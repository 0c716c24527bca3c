"""The batch chain: landing files -> raw -> clean -> data products."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.plans import gold, silver
from quarrylens.sources import sinks
from quarrylens.sources.landing import BAD_COLUMNS, conform, read_feed, resolve_batch, with_ingest_meta
from quarrylens.sources.schemas import FEEDS
from quarrylens.sources.tables import Tables

INGEST = ("_ingested_at", "_source_file")
# A later load of the same key wins; within one load the file path, then the batch, decides.
LOAD_ORDER = ("_ingested_at", "batch_id", "_source_file")


LOAD = "_load"


def land_feed(spark: SparkSession, path: str, feed: str, schema: T.StructType, fmt: str, db: str, loaded_at: datetime) -> dict[str, int]:
    """Write one feed of one batch folder into its partition of ``<feed>_landed``: one read, one overwrite.

    Loading a folder again replaces what it loaded before.  ``<feed>`` shows the rows that fit the
    schema, ``<feed>_rejects`` the others with the names of their bad columns.
    """
    raw = with_ingest_meta(read_feed(spark, f"{path}/{feed}", fmt, schema, text=True), loaded_at)
    fitted, seen = sinks.counted(conform(raw, schema, keep=INGEST, report=True), bad=F.size(BAD_COLUMNS) > 0)
    landed = f"{db}.{feed}_landed"
    sinks.ensure_table(spark, landed, fitted.schema.add(LOAD, T.StringType()), partition_by=[LOAD])
    sinks.overwrite_partition(fitted, landed, {LOAD: path.rstrip("/").rsplit("/", 1)[-1]})
    columns = ", ".join(f"`{c}`" for c in (*schema.names, *INGEST))
    sinks.define_view(spark, f"{db}.{feed}", f"SELECT {columns} FROM {landed} WHERE size({BAD_COLUMNS}) = 0", f"{feed}, raw")
    sinks.define_view(spark, f"{db}.{feed}_rejects", f"SELECT {columns}, {BAD_COLUMNS} FROM {landed} WHERE size({BAD_COLUMNS}) > 0", f"{feed}, rejected")
    return {feed: seen.get["rows"] - seen.get["bad"], f"{feed}_rejects": seen.get["bad"]}


def run_bronze(spark: SparkSession, landing: str, db: str, loaded_at: datetime, batch_id: str | None = None) -> dict[str, int]:
    """Load every feed of one batch folder; a folder counts once, however often it is loaded."""
    path = resolve_batch(spark, landing, batch_id)
    sinks.ensure_db(spark, db, "raw feeds, one partition a batch folder")
    counts: dict[str, int] = {}
    for feed, (schema, fmt) in FEEDS.items():
        counts |= land_feed(spark, path, feed, schema, fmt, db, loaded_at)
    return counts


def run_silver(spark: SparkSession, bronze: str, db: str, as_of: date, processed_at: datetime) -> dict[str, int]:
    sinks.ensure_db(spark, db, "clean feeds")
    order = LOAD_ORDER
    frames = {
        "fleet_positions": silver.fleet_positions(spark.table(f"{bronze}.gps_pings"), order),
        "deliveries": silver.deliveries(spark.table(f"{bronze}.delivery_receipts"), order),
        "inventory_snapshots": silver.inventory_snapshots(spark.table(f"{bronze}.warehouse_stock"), as_of, order),
        "invoices": silver.invoices(spark.table(f"{bronze}.supplier_invoices"), as_of, order),
    }
    return {name: sinks.replace(sinks.stamped(df, processed_at), f"{db}.{name}") for name, df in frames.items()}


def run_gold(spark: SparkSession, clean: str, db: str, processed_at: datetime) -> dict[str, int]:
    sinks.ensure_db(spark, db, "data products")
    t = Tables(
        spark, {n: f"{clean}.{n}" for n in ("fleet_positions", "deliveries", "inventory_snapshots", "invoices")}
    )
    frames = {
        "fleet_utilisation_daily": gold.fleet_utilisation_daily(t["fleet_positions"]),
        "delivery_performance": gold.delivery_performance(t["deliveries"]),
        "inventory_health": gold.inventory_health(t["inventory_snapshots"]),
        "invoice_aging": gold.invoice_aging(t["invoices"]),
        "site_operations_summary": gold.site_operations_summary(t["fleet_positions"], t["deliveries"], t["invoices"]),
        "supplier_scorecard": gold.supplier_scorecard(t["deliveries"], t["invoices"]),
    }
    stamp = lambda df: sinks.stamped(df.drop("_processed_at"), processed_at)
    return {name: sinks.replace(stamp(df), f"{db}.{name}") for name, df in frames.items()}
