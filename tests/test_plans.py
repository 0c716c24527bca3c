"""Physical plans on stored tables: pushdown, pruning, shuffles, no pairing of rows."""

from __future__ import annotations

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from quarrylens.plans.catalogue import CATALOGUE
from quarrylens.plans.operator_queries import DEMOS
from quarrylens.plans.products import PRODUCTS
from quarrylens.sources import sinks
from quarrylens.sources.derived import derived_tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """Derived tables written out, as a site would have them."""
    folder = str(tmp_path_factory.mktemp("ops"))
    names = ["incidents", "telemetry", "materials", "financials", "emissions"]
    for n in names:
        tables[n].write.parquet(f"{folder}/{n}")
    return tables.with_tables(**{n: spark.read.parquet(f"{folder}/{n}") for n in names})


@pytest.mark.parametrize(
    ("key", "pushed", "unread"),
    [
        ("q_sf_01", "EqualTo(status,open)", "root_cause"),
        ("q_sf_12", "EqualTo(site_name,NATION_7)", "corrective_action"),
        ("q_eq_05", "LessThan(fuel_level_pct,20.0)", "hydraulic_pressure_bar"),
        ("q_eq_03", "LessThan(maintenance_due_date,2024-01-30)", "fuel_level_pct"),
        ("q_pr_05", "GreaterThan(lead_time_days,30)", "unit_price_aud"),
        ("q_pj_01", "EqualTo(status,red)", "planned_value_aud"),
        ("q_sf_18", "GreaterThanOrEqual(incident_date,2024-01-01)", "root_cause"),
        ("q_sf_24_water", "StringStartsWith(monitor_type,water)", "wind_direction"),
    ],
)
def test_filters_and_columns_reach_the_scan(stored, key, pushed, unread):
    plan = plan_of(CATALOGUE[key](stored))
    assert pushed in plan
    assert unread not in re.search(r"ReadSchema: (.*)", plan).group(1)


@pytest.mark.parametrize("key", ["q_sf_03", "q_eq_04", "q_pr_17", "q_pj_02", "q_sf_10"])
def test_one_hash_exchange_per_aggregate(stored, key):
    assert plan_of(CATALOGUE[key](stored)).count("Exchange hashpartitioning") == 1


def test_top_k_does_not_sort_everything(stored):
    assert "TakeOrderedAndProject" in plan_of(CATALOGUE["q_pj_04"](stored))


@pytest.mark.parametrize("key", sorted(set(PRODUCTS) | set(CATALOGUE) | set(DEMOS)))
def test_no_cartesian_plans(spark, key):
    """With broadcasting off nothing is left to hide a join without a key."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = derived_tables(spark, DATA)
        df = t[key] if key in PRODUCTS else CATALOGUE[key](t) if key in CATALOGUE else DEMOS[key](t)
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_bucketed_tables_join_without_shuffle(spark):
    sinks.ensure_db(spark, "t_buckets")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("a", "b"):
        df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias(name))
        assert sinks.replace(df, f"t_buckets.{name}", buckets=(4, ["k"])) == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_buckets.a").join(spark.table("t_buckets.b"), "k")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
