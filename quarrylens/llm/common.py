"""Shared steps of the operators: stored intermediate tables, Arrow batches, linked groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.operators.partitions import stored_bytes
from quarrylens.session import shuffles_let_go, work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LOWER_BYTES = bytes(range(65)) + LOWER.encode() + bytes(range(91, 256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage and its shuffle files end there, executors may be lost."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    with shuffles_let_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes in memory of a row with a digest or two, for one byte of it in a stored table.
UNPACKED = 5


def sent_whole(df: DataFrame) -> bool:
    """Whether rows of stored tables are, unpacked, within the session's limit for tables sent to all tasks."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return UNPACKED * stored_bytes(df) <= limit


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0.  A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def map_arrow(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    batch_bytes: int = 4 << 20,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """One output batch per slice of about ``batch_bytes`` of input, so a task's memory is bounded.

    ``done`` is called at the end of a task, to let go what the worker holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            step = max(1, rows * batch_bytes // max(1, batch.nbytes))
            for at in range(0, rows, step):
                yield fn(batch.slice(at, min(step, rows - at)))
        if done:
            done()

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, label: str, limit: int = 100) -> DataFrame:
    """Smallest id reachable from each id of ``edges`` (columns ``a``, ``b`` of one type).

    Alternates two steps until nothing changes: every id links its larger neighbours to the
    smallest id it knows (large star), then its smaller neighbours and itself (small star).
    Each step is one grouped minimum and one join, stored in the shared folder; the number of
    rounds grows with the logarithm of the longest chain.  Returns ``id``, ``component_id`` for
    the ids that occur in an edge; self loops and repeated edges are allowed.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("u <> v")
    pairs = stored(pairs.distinct(), f"{label}-links")
    for _ in range(limit):
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
        # Larger neighbours only; the id itself keeps its link to the minimum when it is not one.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        own = low.where("low < u").select("u", F.col("low").alias("v"))
        large = stored(large.union(own).where("u > v").distinct(), f"{label}-large")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u > v")
        small = small.union(low.select("u", F.col("low").alias("v")))
        small = stored(small.distinct(), f"{label}-small")
        # Done when every id has one link and no minimum is linked further down.
        size = small.agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).first()
        chained = small.select(F.col("v").alias("u")).distinct().join(small, "u", "left_semi").limit(1).count()
        pairs = small
        if size["n"] == size["d"] and not chained:
            break
    else:
        raise RuntimeError(f"groups not closed after {limit} rounds")
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
