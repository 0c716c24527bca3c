"""Joins used across domains, and the arithmetic that replaces fan-out joins.

A join on a low-cardinality dimension (division, site) pairs every row of one side with
every row of the other.  Sums, counts and distinct counts over those pairs follow from one
aggregate per side, so the pairs are never produced: see :func:`fan_out`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, as_col


def join_left_agg(a: DataFrame, aggregates: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left join pre-aggregated sides, each unique on ``on``: row counts do not change."""
    return reduce(lambda acc, b: acc.join(b, list(on), "left"), aggregates, a)


def full_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join keeping one coalesced key."""
    return a.join(b, list(keys), "full")


def full_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer joins one after another on the coalesced key; NULL keys never match."""
    return reduce(lambda a, b: full_on(a, b, [key]), frames)


def fan_out(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join two per-key aggregates that stand for a fan-out join.

    Each side must be unique on ``on`` and carry its row count as ``_rows_a`` / ``_rows_b``.
    Adds ``_pairs`` (rows the row-level join would have), ``_times_a`` (how often each row
    of ``a`` appears) and ``_times_b``.
    """
    joined = a.join(b, list(on), how)
    times_a = F.col("_rows_b") if how == "inner" else F.greatest(F.coalesce(F.col("_rows_b"), F.lit(0)), F.lit(1))
    return joined.withColumns(
        {"_times_a": times_a, "_times_b": F.col("_rows_a"), "_pairs": F.col("_rows_a") * times_a}
    )


def repeat_rows(df: DataFrame, times: Colish, at_most: int) -> DataFrame:
    """Each row ``min(times, at_most)`` times: the multiset a row-level join would show in a top-k."""
    n = F.least(as_col(times).cast("int"), F.lit(at_most))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), n))).drop("_copy")


def sites_with_both(a: DataFrame, b: DataFrame, key: str = "site_name") -> DataFrame:
    """Keys present on both sides, without pairing rows."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def reconcile(detail: DataFrame, kpi: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float) -> DataFrame:
    """Compare totals computed from detail with published totals, per key and measure."""
    d = detail.select(*keys, *[F.col(m).cast("double").alias(f"d_{m}") for m in measures])
    k = kpi.select(*keys, *[F.col(m).cast("double").alias(f"k_{m}") for m in measures])
    pairs = full_on(d, k, keys)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("measure"), F.col(f"d_{m}").alias("detail_value"), F.col(f"k_{m}").alias("kpi_value"))
                for m in measures
            ]
        )
    )
    out = pairs.select(*keys, rows.alias("r")).select(*keys, "r.*")
    diff = F.coalesce(F.col("detail_value"), F.lit(0.0)) - F.coalesce(F.col("kpi_value"), F.lit(0.0))
    missing = F.col("detail_value").isNull() != F.col("kpi_value").isNull()
    return out.withColumn("difference", diff).withColumn(
        "is_aligned", ~missing & (F.abs(diff) <= F.lit(float(tolerance)))
    )
