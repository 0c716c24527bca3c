"""Timesheet questions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs
from quarrylens.functions.numeric import dec, rnd
from quarrylens.functions.predicates import quarter_of
from quarrylens.plans.catalogue.base import query
from quarrylens.sources.tables import Tables

AS_OF = date(2024, 1, 30)
COST = 4  # decimal places of shift costs


def _hours():
    return dec("hours_regular") + dec("hours_overtime")


@query("q_wf_01", "Overtime share per site, flagged above a limit")
def overtime_share(t: Tables, limit_pct: float = 20.0) -> DataFrame:
    share = rnd(aggs.weighted_ratio("hours_overtime", _hours()) * 100.0, 1)
    return (
        t["timesheets"]
        .groupBy("site_name")
        .agg(aggs.total("hours_overtime").alias("overtime_hours"), share.alias("overtime_pct"))
        .withColumn("excessive", F.col("overtime_pct") > limit_pct)
        .orderBy(F.desc("overtime_pct"), "site_name")
    )


@query("q_wf_02", "Shifts and cost of workers without induction")
def uninducted(t: Tables) -> DataFrame:
    return (
        t["timesheets"]
        .filter(~F.col("is_inducted"))
        .groupBy("site_name")
        .agg(
            aggs.distinct("employee_id").alias("workers"),
            aggs.n_rows().alias("shifts"),
            aggs.total("total_cost_aud", COST).alias("cost_aud"),
        )
    )


@query("q_wf_03", "Labour cost per project")
def cost_per_project(t: Tables) -> DataFrame:
    return t["timesheets"].groupBy("project_id").agg(
        aggs.total("total_cost_aud", COST).alias("labour_cost_aud"),
        aggs.total(_hours()).alias("hours"),
        aggs.distinct("employee_id").alias("workers"),
    )


@query("q_wf_04", "Average hours by role")
def hours_by_role(t: Tables) -> DataFrame:
    return t["timesheets"].groupBy("role").agg(
        aggs.avg_rounded("hours_regular", 2).alias("avg_regular"),
        aggs.avg_rounded("hours_overtime", 2).alias("avg_overtime"),
        aggs.avg_rounded(_hours(), 2).alias("avg_hours"),
    )


@query("q_wf_05", "Shifts breaking the cost rule")
def cost_rule_breaks(t: Tables, overtime_factor: str = "1.50", regular_limit: float = 7.6, tolerance: float = 0.01) -> DataFrame:
    d = lambda c: F.col(c).cast("decimal(9,2)")
    expected = d("hours_regular") * d("hourly_rate_aud") + d("hours_overtime") * d("hourly_rate_aud") * F.lit(
        overtime_factor
    ).cast("decimal(4,2)")
    return (
        t["timesheets"]
        .withColumn("expected_cost_aud", expected.cast("double"))
        .filter(
            (F.abs(F.col("total_cost_aud") - F.col("expected_cost_aud")) > tolerance)
            | (F.col("hours_regular") > regular_limit)
        )
        .select("timesheet_id", "employee_id", "total_cost_aud", "expected_cost_aud")
    )


@query("q_wf_06", "Overtime hours and cost by division this quarter")
def overtime_by_division(t: Tables, as_of: date = AS_OF) -> DataFrame:
    extra = dec("hours_overtime") * F.col("hourly_rate_aud").cast("decimal(9,2)") * F.lit("1.5").cast("decimal(2,1)")
    return (
        t["timesheets"]
        .filter(quarter_of("work_date", as_of))
        .groupBy("division")
        .agg(aggs.total("hours_overtime").alias("overtime_hours"), F.sum(extra).cast("double").alias("overtime_cost_aud"))
    )
