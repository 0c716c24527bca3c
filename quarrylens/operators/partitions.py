"""Numbers of partitions that follow the stored input, for shuffles whose tasks sort wide rows.

Adaptive execution merges small partitions but never makes more than the session's number, so with that
number fixed a task's memory grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarrylens.functions.numeric import Colish

PER_TASK = 8 << 20
MOST = 20_000
# A leaf without a size reports more than any table has.
UNKNOWN = 1 << 60


def stored_bytes(df: DataFrame) -> int:
    """Size of the tables a frame reads, by the planner's statistics; those of unknown size count for nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN)


def more_partitions(df: DataFrame) -> int:
    """One partition per ``PER_TASK`` bytes of stored input, or 0 if the session's own number is enough."""
    wanted = min(MOST, -(-stored_bytes(df) // PER_TASK))
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def dealt(df: DataFrame, *keys: Colish) -> DataFrame:
    """Rows dealt by ``keys`` for the join or aggregate on them that follows; as they are where the input is small."""
    number = more_partitions(df)
    return df.repartition(number, *keys) if number else df


def in_order(df: DataFrame, *order: Colish) -> DataFrame:
    """Rows in global order, sorted in as many ranges as the input asks for."""
    number = more_partitions(df)
    return df.repartitionByRange(number, *order).sortWithinPartitions(*order) if number else df.orderBy(*order)
