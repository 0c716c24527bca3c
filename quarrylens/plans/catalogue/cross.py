"""Questions across finance, safety, fleet, procurement and the KPI tables.

Published joins on ``division`` or ``site_name`` pair every row of one table with every row
of the other.  The same totals come from one aggregate per side (``fan_out``); the
``*_safe`` forms give the totals without the repetition.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import dec, exact, pct, ratio, rnd
from quarrylens.functions.predicates import month_start, since_months
from quarrylens.operators.joins import fan_out, join_left_agg, reconcile, sites_with_both
from quarrylens.operators.latest import dedup_latest, latest_snapshot, latest_with_ties
from quarrylens.operators.windows import month_over_month, ranked
from quarrylens.plans import rollups
from quarrylens.plans.catalogue.base import query
from quarrylens.plans.rollups import MONEY
from quarrylens.sources.tables import Tables

AS_OF = date(2024, 6, 30)
FLEET_DAY = date(2024, 1, 30)
ALERT = ("warning", "critical")


def _avg(name: str, places: int) -> Column:
    return aggs.avg_rounded(name, places, 4)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _times(total: str, times: str) -> Column:
    """Exact total repeated: DECIMAL x count, then DOUBLE."""
    return (F.col(total).cast("decimal(24,4)") * F.col(times).cast("decimal(14,0)")).cast("double")


def _incidents_by(t: Tables, *keys: str, rows: DataFrame | None = None) -> DataFrame:
    source = t["incidents"] if rows is None else rows
    return source.groupBy(*keys).agg(
        aggs.n_rows().alias("_rows_b"),
        aggs.distinct("incident_id").alias("incidents"),
        aggs.count_where(rules.is_lti("lost_time_days")).alias("ltis"),
        F.sum(exact("lost_time_days")).alias("_lost"),
    )


@query("q_x_01", "Division finance and safety")
def finance_and_safety(t: Tables) -> DataFrame:
    money = t["financials"].groupBy("division").agg(
        aggs.n_rows().alias("_rows_a"),
        aggs.distinct("project_id").alias("projects"),
        _avg("cpi", 2).alias("avg_cpi"),
        _avg("spi", 2).alias("avg_spi"),
    )
    return (
        fan_out(money, _incidents_by(t, "division"), ["division"])
        .select(
            "division",
            "projects",
            "avg_cpi",
            "avg_spi",
            _zero("incidents").alias("incidents"),
            _times("_lost", "_times_b").alias("lti_days"),
        )
        .orderBy("avg_cpi", "division")
    )


@query("q_x_01_safe", "Division finance and safety, lost days counted once")
def finance_and_safety_safe(t: Tables) -> DataFrame:
    money = t["financials"].groupBy("division").agg(
        aggs.distinct("project_id").alias("projects"), _avg("cpi", 2).alias("avg_cpi"), _avg("spi", 2).alias("avg_spi")
    )
    return join_left_agg(money, [_incidents_by(t, "division")], ["division"]).select(
        "division", "projects", "avg_cpi", "avg_spi", _zero("incidents").alias("incidents"), F.col("_lost").cast("double").alias("lti_days")
    )


def _site_alerts(t: Tables) -> DataFrame:
    return t["telemetry"].filter(F.col("status").isin(*ALERT)).groupBy("site_name").agg(
        aggs.n_rows().alias("_rows_t"), aggs.distinct("equipment_id").alias("equipment_alerts")
    )


@query("q_x_02", "Sites with incidents and equipment alerts")
def incidents_and_alerts(t: Tables) -> DataFrame:
    hurt = _incidents_by(t, "site_name", "division")
    return (
        hurt.join(_site_alerts(t), "site_name")
        .select("site_name", "division", "incidents", _times("_lost", "_rows_t").alias("lost_days"), "equipment_alerts")
        .orderBy(F.desc("incidents"), "site_name")
    )


@query("q_x_02_safe", "Sites with incidents and equipment alerts, lost days counted once")
def incidents_and_alerts_safe(t: Tables) -> DataFrame:
    hurt = _incidents_by(t, "site_name", "division")
    return hurt.join(_site_alerts(t), "site_name").select(
        "site_name", "division", "incidents", F.col("_lost").cast("double").alias("lost_days"), "equipment_alerts"
    )


@query("q_x_02_sites", "Sites having both incidents and alerts")
def both_sites(t: Tables) -> DataFrame:
    return sites_with_both(t["incidents"], t["telemetry"].filter(F.col("status").isin(*ALERT)))


@query("q_x_03", "Incidents against utilisation by division")
def incidents_and_utilisation(t: Tables) -> DataFrame:
    money = t["financials"].groupBy("division").agg(
        aggs.distinct("project_id").alias("projects"), _avg("cpi", 2).alias("avg_cpi")
    )
    fleet = t["telemetry"].groupBy("division").agg(aggs.avg_rounded("utilisation_pct", 1).alias("_util"))
    return (
        join_left_agg(money, [_incidents_by(t, "division"), fleet], ["division"])
        .select(
            "division",
            "projects",
            _zero("_rows_b").alias("incidents"),
            F.coalesce("_util", F.lit(0.0)).alias("avg_equip_util_pct"),
            "avg_cpi",
        )
        .orderBy(F.desc("incidents"), "division")
    )


@query("q_x_04", "Red projects with recent incidents per division")
def red_with_incidents(t: Tables, as_of: date = AS_OF, months: int = 3, safe: bool = False) -> DataFrame:
    """The date test sits in the join condition, so divisions without recent incidents stay."""
    red = (
        latest_snapshot(t["financials"])
        .filter(F.col("status") == "red")
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("_rows_a"),
            aggs.distinct("project_id").alias("red_projects"),
            F.sum(dec("budget_aud", MONEY)).alias("_budget"),
            F.min("cpi").alias("worst_cpi"),
        )
    )
    recent = t["incidents"].filter(since_months("incident_date", as_of, months))
    both = fan_out(red, _incidents_by(t, "division", rows=recent), ["division"])
    once = lambda c: F.col(c).cast("double")
    return both.select(
        "division",
        "red_projects",
        (once("_budget") if safe else _times("_budget", "_times_a")).alias("at_risk_budget"),
        "worst_cpi",
        _zero("incidents").alias("recent_incidents"),
        (once("_lost") if safe else _times("_lost", "_times_b")).alias("total_lost_days"),
    ).orderBy(F.desc("at_risk_budget"), "division")


@query("q_x_04_safe", "Red projects with recent incidents, nothing counted twice")
def red_with_incidents_safe(t: Tables) -> DataFrame:
    return red_with_incidents(t, safe=True)


@query("q_x_05", "Division operational scorecard")
def division_scorecard(t: Tables) -> DataFrame:
    money = (
        latest_snapshot(t["financials"])
        .groupBy("division")
        .agg(
            aggs.distinct("project_id").alias("projects"),
            aggs.total("budget_aud", MONEY).alias("total_budget"),
            aggs.weighted_ratio("earned_value_aud", "planned_value_aud", MONEY).alias("weighted_spi"),
            aggs.weighted_ratio("earned_value_aud", "actual_cost_aud", MONEY).alias("weighted_cpi"),
        )
    )
    hurt = _incidents_by(t, "division").select(
        "division", F.col("_rows_b").alias("total_incidents"), F.col("ltis").alias("lti_count")
    )
    fleet = t["telemetry"].groupBy("division").agg(
        aggs.n_rows().alias("fleet_size"), aggs.rate_pct(F.col("status") == "operational").alias("utilisation_pct")
    )
    return join_left_agg(money, [hurt, fleet], ["division"]).orderBy(F.desc("total_budget"), "division")


@query("q_x_06", "Division summary board view")
def board_view(t: Tables) -> DataFrame:
    return t["division_summary"].orderBy(F.desc("total_budget"), "division")


@query("q_x_06_kpis", "Project KPI view")
def project_kpi_view(t: Tables) -> DataFrame:
    return t["project_kpis"].orderBy(F.desc("total_budget"), "division")


@query("q_x_07", "Monthly KPI trend")
def monthly_trend(t: Tables) -> DataFrame:
    return t["monthly_kpis"].orderBy(F.desc("month"), "division")


@query("q_x_07_recent", "Monthly KPI trend, last months")
def monthly_trend_recent(t: Tables, as_of: date = AS_OF, months: int = 6) -> DataFrame:
    return t["monthly_kpis"].filter(since_months("month", as_of, months)).orderBy(F.desc("month"), "division")


@query("q_x_08", "Cost share of budget by division")
def cost_share(t: Tables) -> DataFrame:
    return (
        t["monthly_kpis"]
        .groupBy("division")
        .agg(
            aggs.total("budget_aud", MONEY).alias("total_budget"),
            aggs.total("actual_cost_aud", MONEY).alias("total_actuals"),
            rnd(aggs.weighted_ratio("actual_cost_aud", "budget_aud", MONEY) * 100.0, 1).alias("cost_pct"),
        )
        .orderBy(F.desc("cost_pct"), "division")
    )


def _facts(section: str, df: DataFrame, *measures: str) -> DataFrame:
    """Long form: section, item, measure, value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]))
    return df.select(F.lit(section).alias("section"), F.col("item"), pairs.alias("p")).select("section", "item", "p.*")


@query("q_x_09", "Executive brief")
def executive_brief(t: Tables) -> DataFrame:
    now = latest_snapshot(t["financials"])
    rag = now.groupBy(F.col("status").alias("item")).agg(aggs.n_rows().alias("projects"))
    money = now.agg(
        F.lit("portfolio").alias("item"),
        aggs.total("budget_aud", MONEY).alias("budget"),
        aggs.total("actual_cost_aud", MONEY).alias("actual"),
    )
    hurt = t["incidents"].filter(rules.is_open("status")).groupBy(F.col("severity").alias("item")).agg(aggs.n_rows().alias("open"))
    supply = t["materials"].filter(rules.supply_risk("availability")).groupBy(F.col("availability").alias("item")).agg(
        aggs.n_rows().alias("materials")
    )
    parts = [
        _facts("rag", rag, "projects"),
        _facts("money", money, "budget", "actual"),
        _facts("incidents", hurt, "open"),
        _facts("supply", supply, "materials"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("q_x_10", "Site brief: finance, equipment and incidents")
def site_brief(t: Tables, site: str = "NATION_7") -> DataFrame:
    money = latest_snapshot(t["financials"]).filter(F.col("state") == site).groupBy(F.col("status").alias("item")).agg(
        aggs.n_rows().alias("projects"), aggs.total("budget_aud", MONEY).alias("budget")
    )
    fleet = (
        latest_with_ties(t["telemetry"].filter(F.col("site_name") == site), ["equipment_id"], "reading_timestamp")
        .groupBy(F.col("status").alias("item"))
        .agg(aggs.n_rows().alias("units"))
    )
    hurt = t["incidents"].filter(F.col("site_name") == site).groupBy(F.col("severity").alias("item")).agg(
        aggs.n_rows().alias("incidents"), aggs.total("lost_time_days").alias("lost_days")
    )
    parts = [
        _facts("finance", money, "projects", "budget"),
        _facts("equipment", fleet, "units"),
        _facts("incidents", hurt, "incidents", "lost_days"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("q_x_11", "Detail against KPI totals")
def kpi_reconciliation(t: Tables, tolerance: float = 0.5) -> DataFrame:
    """Incidents per division: detail rows against the board view and the monthly table."""
    detail = t["incidents"].groupBy("division").agg(
        aggs.n_rows().cast("double").alias("incident_count"), aggs.total("lost_time_days").alias("lost_time_days")
    )
    monthly = t["monthly_kpis"].groupBy("division").agg(
        F.sum("incidents").cast("double").alias("incident_count"), aggs.total("lost_time_days").alias("lost_time_days")
    )
    return reconcile(detail, monthly, ["division"], ["incident_count", "lost_time_days"], tolerance)


@query("q_x_12", "Risky projects")
def risky_projects(t: Tables, ratings: Sequence[str] = ("High", "Critical")) -> DataFrame:
    return (
        t["project_risk_matrix"]
        .filter(F.col("risk_rating").isin(*ratings))
        .select("project_id", "project_name", "risk_score", "risk_rating", "cost_utilisation_pct", "critical_incidents")
        .orderBy(F.desc("risk_score"), "project_id")
    )


@query("q_x_13", "Divisions over budget with rising incidents")
def over_budget_and_rising(t: Tables) -> DataFrame:
    over = t["financials"].groupBy("division").agg(
        aggs.count_where(F.col("actual_cost_aud") > F.col("budget_aud")).alias("over_budget_snapshots")
    )
    moved = month_over_month(t["safety_kpis"], ["division"], "month", "total_incidents")
    rising = moved.filter(F.col("trend") == "rising").groupBy("division").agg(aggs.n_rows().alias("rising_months"))
    return over.join(rising, "division")


@query("q_x_14", "Manufacturing KPIs beside fleet availability")
def manufacturing_and_fleet(t: Tables) -> DataFrame:
    made = t["manufacturing_kpis"].groupBy("division").agg(
        F.sum("throughput_tonnes").alias("throughput_tonnes"),
        rnd(ratio(aggs.total("utilisation_pct"), F.count("utilisation_pct")), 1).alias("plant_utilisation_pct"),
        aggs.total("downtime_hours").alias("downtime_hours"),
        aggs.total("energy_kwh").alias("energy_kwh"),
        F.sum("waste_tonnes").alias("waste_tonnes"),
    )
    return made.join(t["fleet_kpis"].select("division", "availability_pct", "breakdown_count"), "division", "left")


@query("q_x_15", "Incident rate against utilisation by site")
def site_rates(t: Tables) -> DataFrame:
    fleet = t["telemetry"].groupBy("site_name").agg(
        aggs.distinct("equipment_id").alias("units"),
        rules.utilisation("status").alias("in_service_pct"),
    )
    hurt = _incidents_by(t, "site_name").select("site_name", F.col("_rows_b").alias("incidents"))
    return join_left_agg(fleet, [hurt], ["site_name"]).select(
        "site_name",
        "units",
        "in_service_pct",
        _zero("incidents").alias("incidents"),
        rnd(ratio(_zero("incidents"), "units"), 2).alias("incidents_per_unit"),
    )


@query("q_x_16", "Composite division risk")
def composite_risk(t: Tables) -> DataFrame:
    """Our definition: sum of the ranks by cost share, incidents and fleet availability (worst first)."""
    money = t["financials"].groupBy("division").agg(
        rnd(aggs.weighted_ratio("actual_cost_aud", "budget_aud", MONEY) * 100.0, 2).alias("cost_pct")
    )
    hurt = t["incidents"].groupBy("division").agg(aggs.n_rows().alias("incidents"))
    fleet = t["fleet_kpis"].select("division", "availability_pct")
    # Each side is ranked on its own, so no plan is repeated inside another ranking.
    sides = [
        ranked(hurt, "incidents", out="incidents_rank"),
        ranked(fleet, "availability_pct", desc=False, out="availability_pct_rank"),
    ]
    joined = join_left_agg(ranked(money, "cost_pct", out="cost_pct_rank"), sides, ["division"])
    total = F.col("cost_pct_rank") + F.col("incidents_rank") + F.col("availability_pct_rank")
    return joined.withColumn("rank_sum", total).orderBy("rank_sum", "division")


@query("q_x_17", "Behind schedule with rising cost")
def behind_and_rising(t: Tables) -> DataFrame:
    yearly = t["financials"].select("project_id", "project_name", "reporting_period", "spi", "actual_cost_aud")
    moved = month_over_month(yearly, ["project_id"], "reporting_period", "actual_cost_aud")
    # Same partitioning and order as the change itself: no further exchange.
    newest = dedup_latest(moved, ["project_id"], ["reporting_period"]).select(
        "project_id", "project_name", "reporting_period", "spi", "trend", "actual_cost_aud", F.col("previous").alias("previous_cost_aud")
    )
    return newest.filter((F.col("spi") < 1.0) & (F.col("trend") == "rising")).drop("trend")


@query("q_x_18", "Board risk briefing")
def board_risks(t: Tables, as_of: date = FLEET_DAY, cpi_limit: float = 0.85) -> DataFrame:
    """Five counted risk lists in long form."""
    count = aggs.n_rows().cast("double").alias("value")
    low_cpi = latest_snapshot(t["financials"]).filter(F.col("cpi") < cpi_limit)
    critical = t["incidents"].filter((F.col("severity") == "Critical") & rules.is_open("status"))
    late = latest_with_ties(t["telemetry"], ["equipment_id"], "reading_timestamp").filter(
        rules.overdue("maintenance_due_date", as_of, "status")
    )
    contracts = t["supplier_contracts"].filter(rules.contract_expiring("contract_status"))
    audits = t["inspections"].filter(F.col("result") == "fail")
    parts = {
        "low_cpi": low_cpi,
        "open_critical": critical,
        "overdue_maintenance": late,
        "expiring_contracts": contracts,
        "failed_inspections": audits,
    }
    tables = [df.groupBy("division").agg(count).withColumn("risk", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tables).select("risk", "division", "value")


@query("q_x_19", "Monthly inspection pass rate")
def monthly_pass_rate(t: Tables) -> DataFrame:
    passed, failed = F.col("inspections_passed"), F.col("inspections_failed")
    return (
        t["monthly_kpis"]
        .filter(passed + failed > 0)
        .select("month", "division", "inspections_passed", "inspections_failed", rnd(pct(passed, passed + failed), 1).alias("pass_rate_pct"))
    )


@query("q_x_20", "Red projects of a division with incidents and equipment at their sites")
def red_sites(t: Tables, division: str = "ASIA", statuses: tuple[str, ...] = ("red",)) -> DataFrame:
    red = (
        latest_snapshot(t["financials"])
        .filter((F.col("division") == division) & F.col("status").isin(*statuses))
        .groupBy(F.col("state").alias("site_name"))
        .agg(aggs.n_rows().alias("projects"), aggs.total("budget_aud", MONEY).alias("budget_aud"))
    )
    hurt = _incidents_by(t, "site_name").select("site_name", F.col("_rows_b").alias("incidents"))
    fleet = _site_alerts(t).select("site_name", "equipment_alerts")
    return join_left_agg(red, [hurt, fleet], ["site_name"]).na.fill(0, ["incidents", "equipment_alerts"])


@query("q_x_21", "SPI sensitivity: delay if SPI ran between 0.85 and 0.95")
def spi_sensitivity(t: Tables, low: int = 85, high: int = 95, horizon: float = 6.0, monthly_spend: float = 1e5) -> DataFrame:
    """Our definition: months left / SPI - months left; the grid is a fixed array per project.

    Beside the delay to the end: delay and cost if the SPI holds for ``horizon`` months only.
    """
    left = F.col("planned_value_aud") / monthly_spend
    spi = F.col("_spi") / 100.0
    lost = rules.forecast_delay("_left", spi, horizon)
    grid = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("_spi")
    return (
        latest_snapshot(t["financials"])
        .filter(F.col("status") == "amber")
        .select("project_id", left.alias("_left"), grid)
        .select(
            "project_id",
            (F.col("_spi") / 100.0).alias("assumed_spi"),
            rnd(rules.forecast_delay("_left", spi), 2).alias("delay_months"),
            rnd(lost, 4).alias("delay_in_horizon"),
            rnd(rules.forecast_cost(lost, F.lit(monthly_spend)), 0).alias("cost_impact_aud"),
        )
    )


@query("q_x_22", "Portfolio measures: health, availability, incidents month to date")
def portfolio_measures(t: Tables, as_of: date = AS_OF) -> DataFrame:
    parts = [
        rollups.portfolio_health(t["project_kpis"]),
        rollups.fleet_availability(t["fleet_kpis"]),
        rollups.incidents_mtd(t["safety_kpis"], as_of),
    ]
    # One row each; long form avoids pairing them.
    rows = [df.select(F.lit(df.columns[0]).alias("measure"), F.col(df.columns[0]).cast("double").alias("value")) for df in parts]
    return reduce(DataFrame.unionByName, rows)


@query("q_x_23", "Incidents by month and division with change")
def incident_change(t: Tables) -> DataFrame:
    monthly = t["incidents"].groupBy("division", month_start("incident_date").alias("month")).agg(
        aggs.n_rows().alias("incidents")
    )
    return month_over_month(monthly, ["division"], "month", "incidents")
