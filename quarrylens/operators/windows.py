"""Shares, ranks and period-over-period changes.

Window partitions here are only ever as large as the distinct values of one entity's
periods; anything that could be unbounded (a group's members, a global rank) is done with
aggregates and joins instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, as_col, pct


def share_of_group(df: DataFrame, group: Sequence[str], measure: str, out: str = "share_pct") -> DataFrame:
    """Percent of the group's total.  The total is a second aggregate, joined back.

    NULLs in the group columns form a group, as in a window.
    """
    names = [f"_group_{i}" for i in range(len(group))]
    totals = df.groupBy(*[F.col(g).alias(n) for g, n in zip(group, names)]).agg(F.sum(measure).alias("_total"))
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names)])
    return df.join(totals, same).withColumn(out, pct(measure, "_total")).drop("_total", *names)


def concentration(df: DataFrame, group: str, member: str, threshold: float, *aggs) -> DataFrame:
    """Members holding more than ``threshold`` percent of their group's rows."""
    counted = df.groupBy(group, member).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    return share_of_group(counted, [group], "n_rows").filter(F.col("share_pct") > threshold)


def month_over_month(df: DataFrame, keys: Sequence[str], period: str, measure: str) -> DataFrame:
    """Previous value, change and direction per key; input has one row per key and period."""
    w = Window.partitionBy(*keys).orderBy(period)
    prev = F.lag(measure).over(w)
    return df.withColumn("previous", prev).withColumn("change", F.col(measure) - F.col("previous")).withColumn(
        "trend",
        F.when(F.col("change") > 0, "rising").when(F.col("change") < 0, "falling").when(F.col("change") == 0, "flat"),
    )


def ranked(df: DataFrame, by: str, desc: bool = True, out: str = "rank", buckets: int = 256, dense: bool = True) -> DataFrame:
    """Global (dense) rank without a single-task window.

    Distinct values are cut into ranges at approximate quantiles (at most ``buckets``
    limits, one scalar subquery), ranked inside each range, shifted by the number of
    values in the ranges before, and joined back.  Ties on one value are one row here,
    so a value shared by most rows costs nothing extra.  NULL ranks last either way.
    """
    x = F.col(by).cast("double")
    values = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    cuts = [i / buckets for i in range(1, buckets)]
    limits = values.agg(F.percentile_approx(x, cuts, 20 * buckets).alias("_q")).select("_q").scalar()
    below = F.aggregate(F.col("_limits"), F.lit(0), lambda acc, q: acc + (q < x).cast("int"))
    last = F.lit(-1 if desc else buckets)
    values = values.withColumn("_limits", limits).withColumn("_b", F.coalesce(below, last)).drop("_limits")
    sizes = values.groupBy("_b").agg(F.count(F.lit(1)).alias("_values"), F.sum("_n").alias("_rows"))
    # At most ``buckets`` rows, so ordering them in one task is bounded.
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("_b").desc() if desc else F.col("_b"))
    size = "_values" if dense else "_rows"
    offsets = sizes.select("_b", (F.sum(size).over(before) - F.col(size)).alias("_offset"))
    inside = Window.partitionBy("_b").orderBy(F.col(by).desc() if desc else F.col(by))
    if dense:
        position = F.row_number().over(inside)
    else:
        position = F.sum("_n").over(inside) - F.col("_n") + 1
    ranks = values.withColumn("_pos", position).join(offsets, "_b").select(
        F.col(by).alias("_value"), (F.col("_pos") + F.col("_offset")).cast("bigint").alias(out)
    )
    return df.join(ranks, F.col(by).eqNullSafe(F.col("_value"))).drop("_value")


def month_to_date(df: DataFrame, day: str, measure: str, keys: Sequence[str] = ()) -> DataFrame:
    """Running total within each month, on daily totals (at most 31 rows per partition)."""
    daily = df.groupBy(*keys, day).agg(F.sum(measure).alias(measure))
    w = Window.partitionBy(*keys, F.trunc(day, "MM")).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("mtd", F.sum(measure).over(w))


def top_k(df: DataFrame, order: Sequence, k: int, tie: Sequence[Colish] = ()) -> DataFrame:
    """First ``k`` rows; the tie columns make the choice unique (TakeOrderedAndProject)."""
    return df.orderBy(*order, *[as_col(t) for t in tie]).limit(k)


def arg_max(df: DataFrame, by: str, tie: str) -> DataFrame:
    return top_k(df, [F.col(by).desc()], 1, [tie])
