"""Incremental forms of the batch steps.

Sinks are file logs written per micro-batch under ``_batch=<id>`` in overwrite mode, so a
batch that is retried after a failure replaces itself.  Windowed results are merged when read
(newest row per key); unbounded keyed results live in a :class:`KeyedTable`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import Colish, exact, pct, ratio, rnd
from quarrylens.operators.latest import dedup_latest
from quarrylens.sources.landing import BAD_COLUMNS, conform, stream_lines, with_ingest_meta
from quarrylens.streaming.keyed import KeyedTable
from quarrylens.streaming.latest_state import newest_rows


def read_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        # A header that differs from the schema ends the query; stream_ingest reads by name.
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query and surface its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


# --- logs -------------------------------------------------------------------


def write_log(df: DataFrame, path: str, checkpoint: str, mode: str = "append", shape: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write each micro-batch to its own folder; processes what is there and stops."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        rows.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a log, with their number in ``_batch``."""
    return spark.read.option("basePath", path).parquet(f"{path}/_batch=*")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Colish] = ()) -> DataFrame:
    """Newest row per key: by ``order``, then by batch."""
    return dedup_latest(read_log(spark, path), keys, [*order, "_batch"]).drop("_batch")


# --- ingest -----------------------------------------------------------------


def stream_ingest(
    spark: SparkSession,
    landing: str,
    feed: str,
    fmt: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    ingested_at: datetime,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Take up the files not seen before, ``files_per_trigger`` at a time, and stop.

    Each file is read once: the stream's own rows are fitted to the schema and written with the rejects in one
    overwrite of the batch's folder, split by ``_rejected`` (0 or 1), so a batch tried again replaces itself.
    """
    lines = stream_lines(spark, f"{landing}/*/{feed}", fmt, schema, f"{checkpoint}/files", files_per_trigger)
    raw = with_ingest_meta(lines.drop("_batch"), ingested_at)
    rows = conform(raw, schema, keep=("_ingested_at", "_source_file"), report=True)
    rows = rows.withColumn("_rejected", (F.size(BAD_COLUMNS) > 0).cast("int"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("_rejected").parquet(f"{out}/_batch={batch_id}")

    query = rows.writeStream.option("checkpointLocation", f"{checkpoint}/query").foreachBatch(sink).start()
    try:
        # The trigger for available data would take all new files in one micro-batch.
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def stream_dedup(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row per key; a key is forgotten once the watermark has passed it by ``delay``."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def into_table(df: DataFrame, table: KeyedTable, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Commit each micro-batch to a keyed table; processes what is there and stops."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(table.append).start()


# The only state store of Spark that holds operator state.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def operator_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, whatever the session's own setting is.

    A query takes the setting when it starts; on a restart its checkpoint's setting counts.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def stream_upsert_latest(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[Colish], checkpoint: str, buckets: int = 8
) -> tuple[StreamingQuery, KeyedTable]:
    """Keep-latest across batches, in a keyed table that folds itself."""
    table = KeyedTable(df.sparkSession, path, df.schema, tuple(keys), tuple(order), buckets=buckets)
    return into_table(df, table, checkpoint), table


def stream_latest(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    event_time: str | None = None,
    delay: str | None = None,
    silent_for: timedelta | None = None,
    buckets: int = 8,
) -> tuple[StreamingQuery, KeyedTable]:
    """Newest row per key from operator state; only changes reach the table."""
    changes = newest_rows(df, keys, order, event_time, delay, silent_for)
    table = KeyedTable(df.sparkSession, path, changes.schema, tuple(keys), tuple(order), buckets=buckets)
    with operator_state(df.sparkSession):
        return into_table(changes, table, checkpoint, "update"), table


# --- windows ----------------------------------------------------------------


def stream_fleet_daily(positions: DataFrame, delay: str, event_time: str = "ping_timestamp") -> DataFrame:
    """Daily fleet utilisation; pings later than ``delay`` are dropped."""
    moving, idle = F.col("is_moving"), F.col("is_idling")
    return (
        positions.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("_day"), "vehicle_id", "vehicle_type", "site_name")
        .agg(
            aggs.n_rows().alias("total_pings"),
            aggs.count_where(moving).alias("moving_pings"),
            aggs.count_where(idle).alias("idling_pings"),
            aggs.count_where(~F.col("engine_on")).alias("off_pings"),
            F.sum(exact("speed_kmh")).alias("_speed"),
            F.count("speed_kmh").alias("_n_speed"),
            F.max("speed_kmh").alias("_max_speed"),
            F.sum(exact("fuel_level_pct")).alias("_fuel"),
            F.count("fuel_level_pct").alias("_n_fuel"),
            F.min("fuel_level_pct").alias("_min_fuel"),
        )
        .select(
            F.to_date("_day.start").alias("report_date"),
            "vehicle_id",
            "vehicle_type",
            "site_name",
            "total_pings",
            "moving_pings",
            "idling_pings",
            "off_pings",
            rnd(ratio("_speed", "_n_speed"), 1).alias("avg_speed_kmh"),
            rnd("_max_speed", 1).alias("max_speed_kmh"),
            rnd(ratio("_fuel", "_n_fuel"), 1).alias("avg_fuel_pct"),
            rnd("_min_fuel", 1).alias("min_fuel_pct"),
            rnd(pct("moving_pings", "total_pings"), 1).alias("utilisation_pct"),
            rnd(pct("idling_pings", "total_pings"), 1).alias("idle_pct"),
        )
    )


def stream_alerts(readings: DataFrame, delay: str, window: str = "1 hour", slide: str = "15 minutes", event_time: str = "reading_timestamp") -> DataFrame:
    """Sliding windows in which a unit ran hot or low on fuel."""
    hot = F.col("engine_temp_celsius") > 105
    low = rules.low_fuel("fuel_level_pct", "status")
    return (
        readings.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window, slide).alias("_w"), "equipment_id")
        .agg(
            aggs.n_rows().alias("readings"),
            F.max("engine_temp_celsius").alias("max_temp"),
            F.min("fuel_level_pct").alias("min_fuel"),
            aggs.count_where(hot).alias("hot_readings"),
            aggs.count_where(low).alias("low_fuel_readings"),
        )
        .filter((F.col("hot_readings") > 0) | (F.col("low_fuel_readings") > 0))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "equipment_id",
            "readings",
            "max_temp",
            "min_fuel",
            F.coalesce(rules.temp_alert("max_temp"), F.lit("LOW FUEL")).alias("alert_level"),
        )
    )


def stream_idle_sessions(positions: DataFrame, delay: str, gap: str = "15 minutes", event_time: str = "ping_timestamp") -> DataFrame:
    """Runs of idling pings no further apart than ``gap``."""
    return (
        positions.filter(F.col("is_idling"))
        .withWatermark(event_time, delay)
        .groupBy(F.session_window(event_time, gap).alias("_s"), "vehicle_id")
        .agg(aggs.n_rows().alias("idle_pings"))
        .select("vehicle_id", F.col("_s.start").alias("idle_from"), F.col("_s.end").alias("idle_to"), "idle_pings")
    )


def stream_enrich(df: DataFrame, static: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """Stream joined to a static table; Spark broadcasts it when its size allows."""
    return df.join(static, on, how)
