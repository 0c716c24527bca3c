"""Copies of tables that are brought up to date by the key ranges that differ.

Each range of the keys' hash has a digest: how many rows, and two sums over their hashes that do not depend
on order.  Source and copy are compared by digests; only ranges that differ are read again and
written, each as its own partition of the copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.sources import sinks

RANGE = "_range"
RANGES = 256


def range_of(keys: Sequence[str], ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def range_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per range (column ``_range``): row count and digests of the rows as a multiset.

    Each hash also covers which columns are NULL, as a NULL by itself leaves a row's hash as it was.
    """
    values = [*columns, *[F.col(c).isNull() for c in columns]]
    one, other = F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)
    return rows.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(20,0)")).alias("total"), F.bit_xor(other).alias("parity")
    )


def differing_ranges(source: DataFrame, copy: DataFrame, columns: Sequence[str]) -> list[tuple[int, bool]]:
    """(range, source has rows) where the digests differ; at most as many as there are ranges."""
    a, b = range_digests(source, columns).alias("a"), range_digests(copy, columns).alias("b")
    same = F.struct("a.n", "a.total", "a.parity").eqNullSafe(F.struct("b.n", "b.total", "b.parity"))
    found = a.join(b, RANGE, "full").where(~same).select(RANGE, F.col("a.n").isNotNull().alias("present")).collect()
    return sorted((r[RANGE], r["present"]) for r in found)


def refresh_copy(spark: SparkSession, source: DataFrame, target: str, keys: Sequence[str], ranges: int = RANGES) -> list[int]:
    """Make ``target`` equal to ``source`` and return the ranges that had to be written.

    ``target`` is created on first use, partitioned by range; NULL keys share a range.  ``source`` is
    read twice where ranges differ: store one that is costly to compute.
    """
    columns = source.columns
    ranged = source.withColumn(RANGE, range_of(keys, ranges))
    sinks.ensure_table(spark, target, ranged.schema, partition_by=[RANGE])
    if set(spark.table(target).columns) != {*columns, RANGE}:
        raise ValueError(f"{target} has other columns than its source")
    found = differing_ranges(ranged, spark.table(target), columns)
    for number in [r for r, present in found if not present]:
        spark.sql(f"ALTER TABLE {target} DROP PARTITION ({RANGE} = {number})")
    written = [r for r, present in found if present]
    if written:
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows = ranged.where(F.col(RANGE).isin(written)).repartition(len(written), RANGE)
            rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    return [r for r, _ in found]


def copied(spark: SparkSession, target: str) -> DataFrame:
    """The copy without its range column."""
    return spark.table(target).drop(RANGE)
