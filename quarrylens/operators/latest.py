"""Newest row per key.

``row_number() = 1`` is planned with a WindowGroupLimit below the exchange: each map task
keeps one row per key, so a key holding a third of all rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, as_col


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Colish]) -> DataFrame:
    """One row per key: the last by ``order``, which must be total for a fixed answer.

    NULL keys form one group, as in SQL PARTITION BY.
    """
    w = Window.partitionBy(*keys).orderBy(*[as_col(o).desc_nulls_last() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


latest_per_key = dedup_latest


def total_order(df: DataFrame, order: Sequence[Colish]) -> list[Colish]:
    """``order``, then every other sortable column by name: rows that still tie are equal.

    Two different rows of one key in one file then give the same survivor however the data is
    partitioned.
    """
    named = {o for o in order if isinstance(o, str)}
    rest = [f.name for f in df.schema if f.name not in named and "map<" not in f.dataType.simpleString()]
    return [*order, *sorted(rest)]


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: Colish) -> DataFrame:
    """Every row that carries its key's greatest ``order`` value (a join to MAX keeps ties).

    Rows whose ``order`` or key is NULL never equal the maximum, as in the join form.
    """
    present = as_col(order).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    w = Window.partitionBy(*keys).orderBy(as_col(order).desc())
    return df.filter(present).withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk")


def latest_snapshot(df: DataFrame, period: str = "reporting_period") -> DataFrame:
    """Rows of the newest period over the whole table (a scalar MAX subquery)."""
    newest = df.agg(F.max(period).alias("_newest")).select("_newest").scalar()
    return df.filter(F.col(period) == newest)


def last_per_entity(df: DataFrame, keys: Sequence[str], period: str = "reporting_period") -> DataFrame:
    """Newest period of each entity, for tables where entities stop reporting."""
    return latest_with_ties(df, keys, period)
