"""Project finance and earned-value questions.

``financials`` holds one row per project and reporting period.  Questions whose published
form counts every snapshot keep doing so; ``latest_only=True`` restricts them to the newest
period.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import dec, pct, ratio, rnd
from quarrylens.functions.predicates import within_months
from quarrylens.operators.latest import last_per_entity, latest_snapshot
from quarrylens.operators.windows import arg_max, month_over_month, ranked, share_of_group, top_k
from quarrylens.plans.catalogue.base import query
from quarrylens.plans.rollups import MONEY
from quarrylens.sources.tables import Tables

AT_RISK = "amber"


def _fin(t: Tables, latest_only: bool = False) -> DataFrame:
    return latest_snapshot(t["financials"]) if latest_only else t["financials"]


def _m(name: str, places: int = 1) -> Column:
    return rnd(F.col(name) / 1e6, places)


def _overrun() -> Column:
    return F.col("actual_cost_aud") - F.col("budget_aud")


def _dec_overrun() -> Column:
    return dec("actual_cost_aud", MONEY) - dec("budget_aud", MONEY)


def _avg(name: str, places: int) -> Column:
    return aggs.avg_rounded(name, places, 4)


def _status(value: str) -> Column:
    return aggs.count_where(F.col("status") == value)


WEIGHTED = lambda num, den: rnd(aggs.weighted_ratio(num, den, MONEY), 2)


@query("q_pj_01", "Red projects with financials and manager")
def red_projects(t: Tables, status: str = "red", latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .filter(F.col("status") == status)
        .select(
            "project_name", "division", "budget_aud", "actual_cost_aud", "cost_variance_pct", "spi", "cpi", "project_manager"
        )
        .orderBy("cost_variance_pct", "project_name", "budget_aud")
    )


@query("q_pj_02", "Portfolio summary by division")
def portfolio_by_division(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("projects"),
            aggs.scaled("budget_aud", 1e9, 2, MONEY).alias("budget_b"),
            aggs.scaled("actual_cost_aud", 1e9, 2, MONEY).alias("actuals_b"),
            _avg("spi", 3).alias("avg_spi"),
            _avg("cpi", 3).alias("avg_cpi"),
        )
        .orderBy(F.desc("budget_b"), "division")
    )


@query("q_pj_03", "Total portfolio budget against actuals")
def portfolio_total(t: Tables, latest_only: bool = False) -> DataFrame:
    return _fin(t, latest_only).agg(
        aggs.n_rows().alias("total_projects"),
        aggs.scaled("budget_aud", 1e9, 2, MONEY).alias("total_budget_b"),
        aggs.scaled("actual_cost_aud", 1e9, 2, MONEY).alias("total_actuals_b"),
        rnd(F.sum(_dec_overrun()).cast("double") / 1e6, 1).alias("variance_m"),
        _avg("spi", 3).alias("avg_spi"),
        _avg("cpi", 3).alias("avg_cpi"),
    )


@query("q_pj_04", "Largest projects by budget")
def largest_projects(t: Tables, k: int = 10, latest_only: bool = False) -> DataFrame:
    rows = top_k(_fin(t, latest_only), [F.desc("budget_aud")], k, ["project_id", "reporting_period"])
    return rows.select("project_name", "division", "client", "budget_aud", "actual_cost_aud", "status", "spi", "cpi")


@query("q_pj_05", "Projects behind schedule")
def behind_schedule(t: Tables, limit: float = 1.0, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .filter(F.col("spi") < limit)
        .select("project_name", "division", "spi", "cpi", "status", "planned_completion")
        .orderBy("spi", "project_name", "planned_completion")
    )


@query("q_pj_06", "Manager performance")
def manager_performance(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("project_manager")
        .agg(
            aggs.n_rows().alias("projects"),
            _avg("cpi", 3).alias("avg_cpi"),
            _avg("spi", 3).alias("avg_spi"),
            _status("red").alias("red_projects"),
        )
        .orderBy(F.desc("avg_cpi"), "project_manager")
    )


@query("q_pj_07", "Cost overrun by state")
def overrun_by_state(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("state")
        .agg(
            aggs.n_rows().alias("projects"),
            aggs.scaled("budget_aud", 1e9, 2, MONEY).alias("budget_b"),
            rnd(F.sum(_dec_overrun()).cast("double") / 1e6, 1).alias("overrun_m"),
        )
        .orderBy(F.desc("overrun_m"), "state")
    )


@query("q_pj_08", "Estimate at completion of red projects")
def eac_of_red(t: Tables, latest_only: bool = False) -> DataFrame:
    estimate = rules.eac("budget_aud", "cpi")
    return (
        _fin(t, latest_only)
        .filter(F.col("status") == "red")
        .select(
            "project_name",
            "division",
            "budget_aud",
            "actual_cost_aud",
            "cpi",
            rnd(estimate, 0).alias("eac_aud"),
            rnd(estimate - F.col("budget_aud"), 0).alias("forecast_overrun_aud"),
        )
        .orderBy(F.desc("forecast_overrun_aud"), "project_name")
    )


@query("q_pj_09", "Operations health summary")
def health_summary(t: Tables, latest_only: bool = False) -> DataFrame:
    return _fin(t, latest_only).agg(
        aggs.n_rows().alias("total_projects"),
        aggs.scaled("budget_aud", 1e6, 1, MONEY).alias("total_budget_m"),
        aggs.scaled("actual_cost_aud", 1e6, 1, MONEY).alias("total_spent_m"),
        _avg("spi", 2).alias("avg_spi"),
        _avg("cpi", 2).alias("avg_cpi"),
        _avg("pct_complete", 1).alias("avg_completion_pct"),
        _status(AT_RISK).alias("at_risk_projects"),
        aggs.count_where(F.col("cpi") < 0.9).alias("over_budget_projects"),
    )


def _troubled(status: str, limit: float) -> Column:
    return (F.col("status") == status) | (F.col("cpi") < limit) | (F.col("spi") < limit)


@query("q_pj_10", "Projects needing attention")
def needing_attention(t: Tables, status: str = AT_RISK, limit: float = 0.9, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .filter(_troubled(status, limit))
        .select(
            "project_name",
            "division",
            "status",
            _m("budget_aud").alias("budget_m"),
            _m("actual_cost_aud").alias("spent_m"),
            rnd("cost_variance_pct", 1).alias("cv_pct"),
            "spi",
            "cpi",
            "project_manager",
        )
        .orderBy("cpi", "project_name", "spi")
    )


@query("q_pj_11", "Division comparison with completion and at-risk count")
def division_comparison(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("projects"),
            aggs.scaled("budget_aud", 1e6, 1, MONEY).alias("total_budget_m"),
            aggs.scaled("actual_cost_aud", 1e6, 1, MONEY).alias("total_spent_m"),
            _avg("spi", 2).alias("avg_spi"),
            _avg("cpi", 2).alias("avg_cpi"),
            _avg("pct_complete", 1).alias("avg_completion"),
            _status(AT_RISK).alias("at_risk"),
        )
        .orderBy(F.desc("total_budget_m"), "division")
    )


@query("q_pj_12", "Budget against actual per project")
def budget_vs_actual(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .select(
            "project_name",
            "division",
            _m("budget_aud").alias("budget_m"),
            _m("actual_cost_aud").alias("actual_m"),
            rnd((F.col("budget_aud") - F.col("actual_cost_aud")) / 1e6, 1).alias("variance_m"),
            rnd("cost_variance_pct", 1).alias("cv_pct"),
            "status",
            "pct_complete",
        )
        .orderBy("cv_pct", "project_name", "budget_m")
    )


def _largest_overruns(t: Tables, k: int, latest_only: bool) -> DataFrame:
    over = _fin(t, latest_only).filter(F.col("actual_cost_aud") > F.col("budget_aud"))
    return top_k(over, [_overrun().desc()], k, ["project_id", "reporting_period"])


@query("q_pj_13", "Largest overruns")
def largest_overruns(t: Tables, k: int = 5, latest_only: bool = False) -> DataFrame:
    return _largest_overruns(t, k, latest_only).select(
        "project_name",
        "division",
        _m("budget_aud").alias("budget_m"),
        _m("actual_cost_aud").alias("actual_m"),
        rnd(_overrun() / 1e6, 1).alias("overrun_m"),
        "cpi",
        "spi",
        "project_manager",
    )


@query("q_pj_14", "Largest overruns with estimate at completion")
def largest_overruns_eac(t: Tables, k: int = 5, latest_only: bool = False) -> DataFrame:
    return _largest_overruns(t, k, latest_only).select(
        "project_name",
        "division",
        _m("budget_aud").alias("budget_m"),
        _m("actual_cost_aud").alias("actual_m"),
        rnd(_overrun() / 1e6, 1).alias("overrun_m"),
        rnd(rules.eac("budget_aud", "cpi") / 1e6, 1).alias("eac_m"),
        "cpi",
        "spi",
        "project_manager",
    )


@query("q_pj_15", "Red by status or index, with completion")
def red_by_index(t: Tables, status: str = AT_RISK, limit: float = 0.9, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .filter(_troubled(status, limit))
        .select(
            "project_name",
            "division",
            "status",
            _m("budget_aud").alias("budget_m"),
            _m("actual_cost_aud").alias("spent_m"),
            "spi",
            "cpi",
            "pct_complete",
            "project_manager",
        )
        .orderBy("cpi", "project_name", "spi")
    )


@query("q_pj_16", "SPI and CPI by division")
def indices_by_division(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("projects"),
            _avg("spi", 2).alias("avg_spi"),
            _avg("cpi", 2).alias("avg_cpi"),
            aggs.scaled("budget_aud", 1e6, 1, MONEY).alias("total_budget_m"),
            _status(AT_RISK).alias("at_risk"),
        )
        .orderBy("avg_cpi", "division")
    )


@query("q_pj_17", "Completion by division")
def completion_by_division(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("projects"),
            _avg("pct_complete", 1).alias("avg_completion"),
            rnd(F.min("pct_complete"), 1).alias("min_completion"),
            rnd(F.max("pct_complete"), 1).alias("max_completion"),
        )
        .orderBy("avg_completion", "division")
    )


@query("q_pj_18", "Managers with at-risk projects")
def managers_at_risk(t: Tables, latest_only: bool = False) -> DataFrame:
    return (
        _fin(t, latest_only)
        .groupBy("project_manager")
        .agg(
            aggs.n_rows().alias("total_projects"),
            _status(AT_RISK).alias("at_risk"),
            _avg("cpi", 2).alias("avg_cpi"),
            _avg("spi", 2).alias("avg_spi"),
        )
        .filter(F.col("at_risk") > 0)
        .orderBy(F.desc("at_risk"), "project_manager")
    )


@query("q_pj_19", "Latest-period portfolio by division, weighted indices")
def latest_portfolio(t: Tables) -> DataFrame:
    return (
        _fin(t, True)
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("project_count"),
            aggs.total("budget_aud", MONEY).alias("total_budget"),
            aggs.total("actual_cost_aud", MONEY).alias("total_actual_cost"),
            aggs.total("earned_value_aud", MONEY).alias("total_earned_value"),
            WEIGHTED("earned_value_aud", "planned_value_aud").alias("weighted_spi"),
            WEIGHTED("earned_value_aud", "actual_cost_aud").alias("weighted_cpi"),
            _status("red").alias("red_projects"),
            _status("amber").alias("amber_projects"),
        )
        .orderBy(F.desc("total_budget"), "division")
    )


@query("q_pj_20", "Red projects of the latest period with EAC and VAC")
def latest_red_eac(t: Tables, status: str = "red") -> DataFrame:
    estimate = rnd(rules.eac("budget_aud", "cpi"), 0)
    return (
        _fin(t, True)
        .filter(F.col("status") == status)
        .select(
            "project_id",
            "project_name",
            "division",
            "project_manager",
            "budget_aud",
            "actual_cost_aud",
            estimate.alias("eac_aud"),
            (F.col("budget_aud") - estimate).alias("vac_aud"),
            "spi",
            "cpi",
            "cost_variance_pct",
        )
        .orderBy("cost_variance_pct", "project_id")
    )


@query("q_pj_21", "Most behind schedule in the latest period")
def lowest_spi(t: Tables, k: int = 5) -> DataFrame:
    return top_k(_fin(t, True), [F.col("spi")], k, ["project_id"]).select(
        "project_id",
        "project_name",
        "division",
        "spi",
        "cpi",
        "planned_value_aud",
        "earned_value_aud",
        (F.col("planned_value_aud") - F.col("earned_value_aud")).alias("schedule_variance_aud"),
        "planned_completion",
        "status",
    )


@query("q_pj_22", "One division's portfolio by project type")
def division_by_type(t: Tables, division: str = "ASIA") -> DataFrame:
    return (
        _fin(t, True)
        .filter(F.col("division") == division)
        .groupBy("project_type")
        .agg(
            aggs.n_rows().alias("project_count"),
            aggs.total("budget_aud", MONEY).alias("total_budget"),
            WEIGHTED("earned_value_aud", "planned_value_aud").alias("weighted_spi"),
            WEIGHTED("earned_value_aud", "actual_cost_aud").alias("weighted_cpi"),
            aggs.avg_rounded("cost_variance_pct", 1).alias("avg_cost_variance_pct"),
        )
        .orderBy(F.desc("total_budget"), "project_type")
    )


@query("q_pj_23", "Managers with several red or amber projects")
def managers_with_several(t: Tables, statuses: Sequence[str] = ("red", "amber"), more_than: int = 1) -> DataFrame:
    return (
        _fin(t, True)
        .filter(F.col("status").isin(*statuses))
        .groupBy("project_manager")
        .agg(
            aggs.n_rows().alias("at_risk_projects"),
            aggs.total("budget_aud", MONEY).alias("total_budget_at_risk"),
            _avg("cpi", 2).alias("avg_cpi"),
            _avg("spi", 2).alias("avg_spi"),
        )
        .filter(F.col("at_risk_projects") > more_than)
        .orderBy(F.desc("at_risk_projects"), "project_manager")
    )


@query("q_pj_24", "Scalar portfolio benchmarks in one pass")
def portfolio_benchmarks(t: Tables, latest_only: bool = False) -> DataFrame:
    worst = F.min_by(F.struct("project_name", "cpi"), F.struct("cpi", "project_id", "reporting_period"))
    return (
        _fin(t, latest_only)
        .agg(
            aggs.n_rows().alias("project_count"),
            _status("red").alias("red_count"),
            _status(AT_RISK).alias("at_risk_count"),
            rnd(aggs.total("budget_aud", MONEY), 2).alias("total_budget"),
            _avg("cpi", 2).alias("avg_cpi"),
            worst.alias("w"),
        )
        .select(
            "project_count",
            "red_count",
            "at_risk_count",
            "total_budget",
            "avg_cpi",
            F.col("w.project_name").alias("lowest_cpi_project"),
            F.col("w.cpi").alias("lowest_cpi"),
        )
    )


@query("q_pj_25", "Delayed critical-path milestones")
def delayed_milestones(t: Tables, days: int = 30) -> DataFrame:
    names = t["financials"].select("project_id", "project_name", "division").distinct()
    late = t["milestones"].filter(F.col("is_critical_path") & (F.col("delay_days") > days))
    return (
        late.join(names, "project_id")
        .select("milestone_id", "project_id", "project_name", "division", "milestone_type", "planned_date", "actual_date", "delay_days")
        .orderBy(F.desc("delay_days"), "milestone_id")
    )


@query("q_pj_26", "Projects completing in the next months")
def completing_soon(t: Tables, as_of: date = date(2001, 7, 1), months: int = 12) -> DataFrame:
    return (
        last_per_entity(t["financials"], ["project_id"])
        .filter(within_months("planned_completion", as_of, months))
        .select("project_id", "project_name", "division", "planned_completion", "pct_complete", "status")
        .orderBy("planned_completion", "project_id")
    )


@query("q_pj_27", "Divisions ranked by schedule performance")
def division_rank(t: Tables, latest_only: bool = False) -> DataFrame:
    per = _fin(t, latest_only).groupBy("division").agg(_avg("spi", 4).alias("avg_spi"))
    return ranked(per, "avg_spi", out="spi_rank").orderBy("spi_rank", "division")


@query("q_pj_28", "Share of milestones on track")
def milestones_on_track(t: Tables) -> DataFrame:
    return t["milestones"].groupBy("milestone_type").agg(
        aggs.n_rows().alias("milestones"),
        aggs.rate_pct(F.col("status") == "on_track").alias("on_track_pct"),
        aggs.count_where(F.col("status") == "delayed").alias("delayed"),
    )


@query("q_pj_29", "State with the lowest average CPI")
def lowest_cpi_state(t: Tables, latest_only: bool = False) -> DataFrame:
    per = _fin(t, latest_only).groupBy("state").agg(aggs.n_rows().alias("projects"), _avg("cpi", 4).alias("avg_cpi"))
    return top_k(per, [F.col("avg_cpi")], 1, ["state"])


@query("q_pj_30", "Red share of each division's portfolio")
def red_share(t: Tables) -> DataFrame:
    return _fin(t, True).groupBy("division").agg(
        aggs.n_rows().alias("projects"),
        _status("red").alias("red_projects"),
        aggs.rate_pct(F.col("status") == "red").alias("red_share_pct"),
        rnd(
            ratio(aggs.total_if(F.col("status") == "red", "budget_aud", MONEY), aggs.total("budget_aud", MONEY)) * 100.0, 1
        ).alias("red_budget_share_pct"),
    )


@query("q_pj_31", "Estimate at completion for one division")
def division_eac(t: Tables, division: str = "EUROPE") -> DataFrame:
    return (
        _fin(t, True)
        .filter(F.col("division") == division)
        .select(
            "project_id",
            "project_name",
            "budget_aud",
            "cpi",
            rnd(rules.eac("budget_aud", "cpi"), 0).alias("eac_aud"),
            rnd(rules.vac("budget_aud", "cpi"), 0).alias("vac_aud"),
        )
        .orderBy(F.desc("eac_aud"), "project_id")
    )


@query("q_pj_32", "Budget at risk in red projects by division")
def budget_at_risk(t: Tables) -> DataFrame:
    red = F.col("status") == "red"
    return _fin(t, True).groupBy("division").agg(
        F.coalesce(aggs.total_if(red, "budget_aud", MONEY), F.lit(0.0)).alias("budget_at_risk"),
        aggs.total("budget_aud", MONEY).alias("total_budget"),
        aggs.count_where(red).alias("red_projects"),
    )


@query("q_pj_33", "Worst cost variance")
def worst_cost_variance(t: Tables, k: int = 5) -> DataFrame:
    rows = top_k(_fin(t, True), [F.col("cost_variance_pct")], k, ["project_id"])
    return rows.select("project_id", "project_name", "division", "cost_variance_pct", "cpi", "status")


@query("q_pj_34", "Quarter against previous quarter: SPI, CPI and incidents by division")
def quarterly_change(t: Tables) -> DataFrame:
    q = lambda c: F.to_date(F.date_trunc("quarter", F.col(c)))
    money = t["financials"].groupBy("division", q("reporting_period").alias("quarter")).agg(
        _avg("spi", 3).alias("avg_spi"), _avg("cpi", 3).alias("avg_cpi")
    )
    hurt = t["incidents"].groupBy("division", q("incident_date").alias("quarter")).agg(aggs.n_rows().alias("incidents"))
    both = money.join(hurt, ["division", "quarter"], "full")
    for name in ("avg_spi", "avg_cpi", "incidents"):
        moved = month_over_month(both, ["division"], "quarter", name)
        change = rnd("change", 3) if name != "incidents" else F.col("change")
        both = moved.withColumn(f"{name}_change", change).drop("previous", "change", "trend")
    return both


@query("q_pj_35", "Project count and overrun of one state")
def state_totals(t: Tables, state: str = "NATION_7") -> DataFrame:
    return t["financials"].filter(F.col("state") == state).agg(
        aggs.distinct("project_id").alias("projects"),
        rnd(F.sum(_dec_overrun()).cast("double"), 2).alias("overrun_aud"),
        rnd(pct(F.sum(_dec_overrun()), F.sum(dec("budget_aud", MONEY))), 1).alias("overrun_pct"),
    )


@query("q_pj_36", "Status split and status share per division")
def status_share(t: Tables, latest_only: bool = False) -> DataFrame:
    counted = _fin(t, latest_only).groupBy("division", "status").agg(aggs.n_rows().alias("projects"))
    return share_of_group(counted, ["division"], "projects", "_s").withColumn("share_pct", rnd("_s", 1)).drop("_s")


@query("q_pj_37", "Division holding the largest budget")
def largest_division(t: Tables) -> DataFrame:
    per = t["financials"].groupBy("division").agg(aggs.total("budget_aud", MONEY).alias("total_budget"))
    return arg_max(per, "total_budget", "division")
