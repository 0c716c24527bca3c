"""Every query under its key, bound to the derived tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.functions.numeric import rnd
from quarrylens.plans.catalogue import CATALOGUE
from quarrylens.plans.operator_queries import DEMOS, STREAMS
from quarrylens.plans.products import PRODUCTS
from quarrylens.sources.derived import derived_tables

Registered = Callable[[SparkSession, str], DataFrame]

# Parameters for the given tables, where the published value matches nothing in them.
PARAMETERS = {"q_pr_20": {"threshold": 2.0}}



def _plain_time(df: DataFrame, name: str) -> DataFrame:
    """Timestamp without zone, as the SQL twin has it."""
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


# Output shaping: whole products; rounding and zone-free times as the SQL twins have them.
SHAPES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "silver_deliveries": lambda df: df.withColumn("cost_variance_pct", rnd("cost_variance_pct", 6)),
    "silver_inventory": lambda df: _plain_time(df, "snapshot_timestamp"),
    "gold_inventory_health": lambda df: _plain_time(df, "snapshot_timestamp"),
    "silver_fleet_positions": lambda df: _plain_time(df, "ping_timestamp"),
}


def registered() -> dict[str, Registered]:
    out: dict[str, Registered] = {}
    for name in PRODUCTS:
        shape = SHAPES.get(name, lambda df: df)
        out[name] = lambda spark, folder, n=name, s=shape: s(derived_tables(spark, folder)[n])
    for key, q in CATALOGUE.items():
        params = PARAMETERS.get(key, {})
        out[key] = lambda spark, folder, q=q, p=params: q(derived_tables(spark, folder), **p)
    for key, fn in DEMOS.items():
        out[key] = lambda spark, folder, fn=fn: fn(derived_tables(spark, folder))
    out.update(STREAMS)
    return out
