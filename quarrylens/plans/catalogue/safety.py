"""Safety, environment and quality questions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import exact, pct, ratio, rnd
from quarrylens.functions.predicates import (
    after_hour,
    domain_rank,
    flag,
    month_start,
    previous_month,
    quarter_of,
    same_year,
    since_months,
    within_days,
)
from quarrylens.functions.vocab import OPEN_STATUSES, SEVERITIES, SIGNIFICANT
from quarrylens.operators.aggregate import by, by_period, order_by_domain
from quarrylens.operators.joins import join_left_agg
from quarrylens.operators.latest import latest_snapshot
from quarrylens.operators.partitions import in_order
from quarrylens.operators.windows import arg_max, month_over_month, share_of_group, top_k
from quarrylens.plans.catalogue.base import query
from quarrylens.sources.tables import Tables

AS_OF = date(2024, 6, 30)
EVENT_DAY = date(2024, 1, 30)
BRIEF = ["incident_id", "incident_date", "site_name", "division", "incident_type", "severity", "injuries", "lost_time_days"]
DETAIL = ["description", "injuries", "lost_time_days", "root_cause", "corrective_action"]


def _sev() -> Column:
    return F.col("severity")


def _lost(places: int | None = None) -> Column:
    total = aggs.total("lost_time_days")
    return total if places is None else rnd(total, places)


def _lti() -> Column:
    return aggs.count_where(rules.is_lti("lost_time_days"))


def _n(cond: Column, name: str) -> Column:
    return aggs.count_where(cond).alias(name)


@query("q_sf_01", "Open incidents, newest first")
def open_incidents(t: Tables, status: str = "open") -> DataFrame:
    return t["incidents"].filter(F.col("status") == status).select(*BRIEF).orderBy(F.desc("incident_date"), "incident_id")


@query("q_sf_02", "Incidents, injuries and lost days by division and severity")
def by_division_severity(t: Tables) -> DataFrame:
    measures = [
        aggs.n_rows().alias("incidents"),
        aggs.total_int("injuries").alias("total_injuries"),
        _lost().alias("total_lti_days"),
    ]
    return by(t["incidents"], ["division", "severity"], *measures).orderBy("division", domain_rank("severity", SEVERITIES))


@query("q_sf_03", "Root causes")
def root_causes(t: Tables) -> DataFrame:
    return (
        t["incidents"]
        .groupBy("root_cause")
        .agg(
            aggs.n_rows().alias("incidents"),
            aggs.total_int("injuries").alias("injuries"),
            aggs.avg_rounded("lost_time_days", 1).alias("avg_lti_days"),
        )
        .orderBy(F.desc("incidents"), "root_cause")
    )


@query("q_sf_04", "Sites with the most incidents")
def top_sites(t: Tables, k: int = 15) -> DataFrame:
    per = t["incidents"].groupBy("site_name", "division").agg(
        aggs.n_rows().alias("incidents"), _n(_sev().isin(*SIGNIFICANT), "critical_serious")
    )
    return top_k(per, [F.desc("incidents")], k, ["site_name", "division"])


@query("q_sf_05", "Monthly incident trend")
def monthly_trend(t: Tables) -> DataFrame:
    measures = [aggs.n_rows().alias("incidents"), aggs.total_int("injuries").alias("injuries")]
    return by_period(t["incidents"], "incident_date", "month", *measures).orderBy("month")


@query("q_sf_06", "Critical incidents in full")
def critical_incidents(t: Tables, severity: str = "Critical") -> DataFrame:
    return (
        t["incidents"]
        .filter(_sev() == severity)
        .select("incident_id", "incident_date", "site_name", "division", "incident_type", *DETAIL, "status")
        .orderBy(F.desc("incident_date"), "incident_id")
    )


@query("q_sf_07", "Portfolio safety record")
def safety_record(t: Tables) -> DataFrame:
    near = flag("is_near_miss")
    return t["incidents"].agg(
        aggs.n_rows().alias("total_incidents"),
        _n(_sev() == "Critical", "critical"),
        _n(_sev() == "Serious", "high"),
        _n(near, "near_misses"),
        _lost(1).alias("total_lti_days"),
        _n(rules.is_lti("lost_time_days") & ~near, "lti_count"),
    )


@query("q_sf_08", "Month by severity")
def month_by_severity(t: Tables) -> DataFrame:
    measures = [
        aggs.n_rows().alias("total"),
        *aggs.status_counts("severity", SEVERITIES),
        _n(F.col("is_near_miss"), "near_misses"),
        _lost(1).alias("total_lti_days"),
    ]
    return by_period(t["incidents"], "incident_date", "month", *measures).orderBy("month")


@query("q_sf_09", "Root causes of significant incidents")
def significant_causes(t: Tables, severities: Sequence[str] = SIGNIFICANT) -> DataFrame:
    return (
        t["incidents"]
        .filter(_sev().isin(*severities))
        .groupBy("root_cause")
        .agg(
            aggs.n_rows().alias("incidents"),
            _lost(1).alias("total_lti_days"),
            aggs.total_int("injuries").alias("total_injuries"),
        )
        .orderBy(F.desc("incidents"), "root_cause")
    )


@query("q_sf_10", "Environmental exceedances by site and monitor")
def exceedances(t: Tables) -> DataFrame:
    return (
        t["emissions"]
        .groupBy("site_name", "monitor_type", "unit")
        .agg(
            aggs.n_rows().alias("total_readings"),
            _n(F.col("is_exceedance"), "exceedances"),
            aggs.rate_pct(F.col("is_exceedance")).alias("exceedance_rate_pct"),
            rnd(F.max("measurement_value"), 1).alias("max_reading"),
            aggs.avg_rounded("threshold_value", 1).alias("threshold"),
        )
        .orderBy(F.desc("exceedances"), "site_name", "monitor_type", "unit")
    )


def _per_project_inspections(t: Tables) -> DataFrame:
    return t["inspections"].groupBy("project_id").agg(
        aggs.n_rows().alias("_n"),
        _n(F.col("result") == "pass", "_passed"),
        _n(F.col("result") == "fail", "_failed"),
        F.sum(F.coalesce(F.col("rework_cost_aud").cast("decimal(18,4)"), F.lit(0))).alias("_rework"),
    )


@query("q_sf_11", "Inspection pass rate and rework cost by project")
def pass_rate_by_project(t: Tables, safe: bool = False) -> DataFrame:
    """The published join repeats an inspection for every snapshot of its project.

    Those repeats are counted, not produced; ``safe=True`` counts each inspection once.
    """
    names = t["financials"].groupBy("project_id", "project_name", "division").agg(aggs.n_rows().alias("_snapshots"))
    times = F.lit(1) if safe else F.col("_snapshots")
    total = F.sum(F.col("_n") * times)
    passed = F.sum(F.col("_passed") * times)
    return (
        _per_project_inspections(t)
        .join(names, "project_id")
        .groupBy("project_name", "division")
        .agg(
            total.alias("total_inspections"),
            passed.alias("passed"),
            F.sum(F.col("_failed") * times).alias("failed"),
            rnd(pct(passed, total), 1).alias("pass_rate_pct"),
            rnd(F.sum(F.col("_rework").cast("decimal(28,4)") * times.cast("decimal(9,0)")), 2).alias("total_rework_cost"),
        )
        .orderBy("pass_rate_pct", "project_name", "division")
    )


@query("q_sf_11_safe", "Inspection pass rate by project, each inspection once")
def pass_rate_by_project_safe(t: Tables) -> DataFrame:
    return pass_rate_by_project(t, safe=True)


@query("q_sf_12", "Incidents of one site")
def site_incidents(t: Tables, site: str = "NATION_7") -> DataFrame:
    return (
        t["incidents"]
        .filter(F.col("site_name") == site)
        .select(
            "incident_id",
            "incident_date",
            "shift",
            "incident_type",
            "severity",
            "description",
            "injuries",
            "lost_time_days",
            "root_cause",
            "status",
        )
        .orderBy(F.desc("incident_date"), "incident_id")
    )


@query("q_sf_13", "Sites needing dust suppression")
def dust_suppression(t: Tables, monitors: Sequence[str] = ("dust_pm10", "dust_pm2_5"), newest_action: bool = False) -> DataFrame:
    """``newest_action`` takes the action of the newest reading instead of MAX(text).

    Readings are hashed down to (site, action) first; only those few rows meet the text maximum.
    """
    newest = [F.max(F.struct("reading_date", "reading_time", "reading_id")).alias("_at")] if newest_action else []
    per_action = (
        t["emissions"]
        .filter(F.col("monitor_type").isin(*monitors))
        .groupBy("site_name", "action_taken")
        .agg(
            aggs.n_rows().alias("_n"),
            _n(F.col("is_exceedance"), "_over"),
            F.max("measurement_value").alias("_max"),
            F.sum(exact("threshold_value")).alias("_limit"),
            F.count("threshold_value").alias("_n_limit"),
            *newest,
        )
    )
    action = F.max_by("action_taken", "_at") if newest_action else F.max("action_taken")
    return (
        per_action.groupBy("site_name")
        .agg(
            F.sum("_n").alias("dust_readings"),
            F.sum("_over").alias("exceedances"),
            rnd(F.max("_max"), 1).alias("max_dust"),
            rnd(ratio(F.sum("_limit"), F.sum("_n_limit")), 1).alias("threshold"),
            action.alias("latest_action"),
        )
        .filter(F.col("exceedances") > 0)
        .orderBy(F.desc("exceedances"), "site_name")
    )


@query("q_sf_13_safe", "Sites needing dust suppression, action of the newest reading")
def dust_suppression_safe(t: Tables) -> DataFrame:
    return dust_suppression(t, newest_action=True)


@query("q_sf_14", "Shift comparison")
def shift_comparison(t: Tables) -> DataFrame:
    return (
        t["incidents"]
        .groupBy("shift")
        .agg(
            aggs.n_rows().alias("incidents"),
            _n(_sev().isin(*SIGNIFICANT), "serious"),
            _lost(1).alias("lti_days"),
            _n(F.col("is_near_miss"), "near_misses"),
        )
        .orderBy(F.desc("incidents"), "shift")
    )


@query("q_sf_15", "Failed weld and concrete tests")
def failed_tests(t: Tables, kinds: Sequence[str] = ("weld_test", "concrete_test")) -> DataFrame:
    """As published: the join to the project snapshots repeats a test once per snapshot."""
    return _failed_tests(t, t["financials"].select("project_id", "project_name"), kinds)


@query("q_sf_15_safe", "Failed weld and concrete tests, each once")
def failed_tests_once(t: Tables, kinds: Sequence[str] = ("weld_test", "concrete_test")) -> DataFrame:
    """One row per inspection: the project name comes from the distinct project list."""
    return _failed_tests(t, t["financials"].select("project_id", "project_name").distinct(), kinds)


def _failed_tests(t: Tables, names: DataFrame, kinds: Sequence[str]) -> DataFrame:
    failed = t["inspections"].filter((F.col("result") == "fail") & F.col("inspection_type").isin(*kinds))
    rows = failed.join(names, "project_id", "left").select(
        "inspection_id",
        "project_name",
        "site_name",
        "inspection_type",
        "discipline",
        "defect_category",
        F.col("severity").alias("defect_severity"),
        "rework_cost_aud",
        "inspector",
        "inspection_date",
    )
    return in_order(rows, F.desc("inspection_date"), "inspection_id")


@query("q_sf_16", "Night noise compliance")
def night_noise(t: Tables, monitor: str = "noise_db", start: str = "18:00") -> DataFrame:
    return (
        t["emissions"]
        .filter((F.col("monitor_type") == monitor) & after_hour("reading_time", start))
        .groupBy("site_name")
        .agg(
            aggs.n_rows().alias("night_noise_readings"),
            _n(F.col("is_exceedance"), "exceedances"),
            aggs.avg_rounded("measurement_value", 1).alias("avg_noise_db"),
            rnd(F.max("measurement_value"), 1).alias("max_noise_db"),
            aggs.avg_rounded("threshold_value", 1).alias("limit_db"),
        )
        .orderBy(F.desc("exceedances"), "site_name")
    )


@query("q_sf_17", "Monthly summary by division, last months")
def recent_monthly_summary(t: Tables, as_of: date = AS_OF, months: int = 3) -> DataFrame:
    return (
        t["incidents"]
        .filter(since_months("incident_date", as_of, months))
        .groupBy("division", F.date_format("incident_date", "yyyy-MM").alias("incident_month"))
        .agg(
            aggs.n_rows().alias("total_incidents"),
            _n(_sev().isin(*SIGNIFICANT), "significant_incidents"),
            _lti().alias("lti_count"),
            _lost().alias("total_lost_days"),
            aggs.total_int("injuries").alias("total_injuries"),
        )
        .orderBy("division", "incident_month")
    )


@query("q_sf_18", "Sites with the most incidents this year")
def sites_this_year(t: Tables, as_of: date = AS_OF, k: int = 10) -> DataFrame:
    per = (
        t["incidents"]
        .filter(same_year("incident_date", as_of))
        .groupBy("site_name", "division")
        .agg(
            aggs.n_rows().alias("incident_count"),
            _lti().alias("lti_count"),
            _lost().alias("total_lost_days"),
            _n(_sev() == "Critical", "critical_count"),
            _n(F.col("status").isin(*OPEN_STATUSES), "open_actions"),
        )
    )
    return top_k(per, [F.desc("incident_count")], k, ["site_name", "division"])


@query("q_sf_19", "Root causes of lost-time injuries")
def lti_causes(t: Tables) -> DataFrame:
    return (
        t["incidents"]
        .filter(rules.is_lti("lost_time_days"))
        .groupBy("root_cause")
        .agg(
            aggs.n_rows().alias("lti_count"),
            _lost().alias("total_lost_days"),
            aggs.avg_rounded("lost_time_days", 1).alias("avg_lost_days_per_lti"),
            aggs.total_int("injuries").alias("total_injuries"),
        )
        .orderBy(F.desc("lti_count"), "root_cause")
    )


@query("q_sf_20", "Open significant incidents")
def open_significant(t: Tables) -> DataFrame:
    rows = t["incidents"].filter(_sev().isin(*SIGNIFICANT) & rules.is_open("status"))
    shown = rows.select(*BRIEF, "description", "root_cause", "corrective_action", "status")
    return order_by_domain(shown, "severity", SEVERITIES, F.desc("incident_date"), "incident_id")


@query("q_sf_21", "Severity share within division this year")
def severity_share(t: Tables, as_of: date = AS_OF) -> DataFrame:
    counted = (
        t["incidents"]
        .filter(same_year("incident_date", as_of))
        .groupBy("division", "severity")
        .agg(aggs.n_rows().alias("incident_count"))
    )
    return (
        share_of_group(counted, ["division"], "incident_count", "_share")
        .select("division", "severity", "incident_count", rnd("_share", 1).alias("pct_of_division"))
        .orderBy("division", domain_rank("severity", SEVERITIES))
    )


@query("q_sf_22", "Safety KPI trend, last months")
def kpi_trend(t: Tables, as_of: date = AS_OF, months: int = 6) -> DataFrame:
    return (
        t["safety_kpis"]
        .filter(since_months("month", as_of, months))
        .select("division", "month", "total_incidents", "near_misses", "ltis", "lost_time_days")
        .orderBy(F.desc("month"), "division")
    )


@query("q_sf_23", "Lost-time injuries by division, latest month")
def latest_month_ltis(t: Tables) -> DataFrame:
    return (
        latest_snapshot(t["safety_kpis"], "month")
        .groupBy("division")
        .agg(
            F.sum("ltis").alias("total_ltis"),
            F.sum("total_incidents").alias("total_incidents"),
            _lost().alias("total_lost_days"),
        )
        .orderBy(F.desc("total_ltis"), "division")
    )


@query("q_sf_24", "Safety benchmarks in one pass")
def safety_benchmarks(t: Tables) -> DataFrame:
    critical = _sev() == "Critical"
    return t["incidents"].agg(
        aggs.n_rows().alias("total_incidents"),
        _n(F.col("status") == "open", "open_incidents"),
        _lost().alias("lost_days"),
        _n(critical & (F.col("status") != "closed"), "critical_not_closed"),
        _n(F.col("is_near_miss"), "near_misses"),
    )


def _most(t: Tables, key: str, cond: Column | None = None) -> DataFrame:
    rows = t["incidents"] if cond is None else t["incidents"].filter(cond)
    return arg_max(rows.groupBy(key).agg(aggs.n_rows().alias("cnt")), "cnt", key)


@query("q_sf_24_division", "Division with the most incidents")
def top_division(t: Tables) -> DataFrame:
    return _most(t, "division")


@query("q_sf_24_serious", "Division with the most significant incidents")
def top_serious_division(t: Tables) -> DataFrame:
    return _most(t, "division", _sev().isin(*SIGNIFICANT))


@query("q_sf_24_site", "Site with the most incidents")
def top_site(t: Tables) -> DataFrame:
    return _most(t, "site_name")


@query("q_sf_24_type", "Most common incident type")
def top_type(t: Tables) -> DataFrame:
    return _most(t, "incident_type")


@query("q_sf_24_critical", "Critical incident list")
def critical_list(t: Tables) -> DataFrame:
    return t["incidents"].filter(_sev() == "Critical").select("incident_id", "incident_date", "site_name", "severity")


@query("q_sf_24_rework", "Total rework cost")
def total_rework(t: Tables) -> DataFrame:
    return t["inspections"].filter(F.col("result") == "fail").agg(
        rnd(aggs.total("rework_cost_aud", 4), 2).alias("total_rework_cost")
    )


@query("q_sf_24_dust", "Dust exceedance rate at one site")
def dust_rate(t: Tables, site_like: str = "%N_7%") -> DataFrame:
    rows = t["emissions"].filter(F.col("site_name").like(site_like) & F.col("monitor_type").like("dust%"))
    return rows.agg(aggs.rate_pct(F.col("is_exceedance")).alias("exceedance_rate_pct"))


@query("q_sf_24_water", "Water quality exceedances")
def water_exceedances(t: Tables) -> DataFrame:
    rows = t["emissions"].filter(F.col("monitor_type").like("water%") & F.col("is_exceedance"))
    return rows.select("site_name", "measurement_value", "threshold_value")


@query("q_sf_25", "Lost-time injury frequency rate by site")
def frequency_rate(t: Tables) -> DataFrame:
    hours = t["timesheets"].groupBy("site_name").agg(
        (aggs.total("hours_regular") + aggs.total("hours_overtime")).alias("hours_worked")
    )
    hurt = t["incidents"].groupBy("site_name").agg(_lti().alias("ltis"), _n(F.col("injuries") > 0, "recordables"))
    return join_left_agg(hurt, [hours], ["site_name"]).select(
        "site_name",
        "ltis",
        "hours_worked",
        rnd(rules.ltifr("ltis", "hours_worked"), 2).alias("ltifr"),
        rnd(rules.trifr("recordables", "hours_worked"), 2).alias("trifr"),
    )


@query("q_sf_25_division", "Lost-time injury frequency rate by division and month, with its trend")
def frequency_rate_trend(t: Tables) -> DataFrame:
    hours = t["timesheets"].groupBy("division", month_start("work_date").alias("month")).agg(
        (aggs.total("hours_regular") + aggs.total("hours_overtime")).alias("hours_worked")
    )
    hurt = t["incidents"].groupBy("division", month_start("incident_date").alias("month")).agg(_lti().alias("ltis"))
    rates = join_left_agg(hurt, [hours], ["division", "month"]).withColumn("ltifr", rnd(rules.ltifr("ltis", "hours_worked"), 2))
    return month_over_month(rates, ["division"], "month", "ltifr").select(
        "division", "month", "ltis", "hours_worked", "ltifr", "previous", "trend"
    )


@query("q_sf_26", "First-pass inspection rate by site")
def first_pass_rate(t: Tables) -> DataFrame:
    return t["inspections"].groupBy("site_name").agg(
        aggs.n_rows().alias("inspections"),
        aggs.rate_pct(F.col("result") == "pass").alias("first_pass_rate_pct"),
        aggs.rate_pct(F.col("rework_required")).alias("rework_rate_pct"),
    )


@query("q_sf_26_project", "First-pass inspection rate by project")
def first_pass_rate_by_project(t: Tables) -> DataFrame:
    return t["inspections"].groupBy("project_id").agg(
        aggs.n_rows().alias("inspections"), aggs.rate_pct(F.col("result") == "pass").alias("first_pass_rate_pct")
    )


@query("q_sf_27", "Sites with rising incident frequency")
def rising_sites(t: Tables) -> DataFrame:
    monthly = by_period(t["incidents"], "incident_date", "month", aggs.n_rows().alias("incidents"), keys=["site_name"])
    moved = month_over_month(monthly, ["site_name"], "month", "incidents")
    return moved.filter(F.col("trend") == "rising").select("site_name", "month", "incidents", "previous", "change")


@query("q_sf_28", "Near-miss ratio by division")
def near_miss_ratio(t: Tables) -> DataFrame:
    return t["incidents"].groupBy("division").agg(
        _n(F.col("is_near_miss"), "near_misses"),
        aggs.n_rows().alias("incidents"),
        aggs.rate_pct(F.col("is_near_miss")).alias("near_miss_pct"),
    )


@query("q_sf_29", "Lost days by division, optionally one division and quarter")
def lost_days(t: Tables, division: str | None = None, quarter: date | None = AS_OF) -> DataFrame:
    rows = t["incidents"]
    if division:
        rows = rows.filter(F.col("division") == division)
    if quarter:
        rows = rows.filter(quarter_of("incident_date", quarter))
    return rows.groupBy("division").agg(_lost().alias("lost_days"), _lti().alias("ltis"))


@query("q_sf_30", "Sites with many incidents in the last days")
def busy_sites(t: Tables, as_of: date = AS_OF, days: int = 30, more_than: int = 3) -> DataFrame:
    return (
        t["incidents"]
        .filter(within_days("incident_date", as_of, -days))
        .groupBy("site_name")
        .agg(aggs.n_rows().alias("incidents"))
        .filter(F.col("incidents") > more_than)
    )


@query("q_sf_31", "Incidents last month; critical ones this quarter and in six months")
def recent_counts(t: Tables, as_of: date = AS_OF) -> DataFrame:
    day, critical = "incident_date", _sev() == "Critical"
    upto = F.col(day) <= F.lit(as_of)
    return t["incidents"].agg(
        _n(previous_month(day, as_of), "last_month"),
        _n(critical & quarter_of(day, as_of), "critical_this_quarter"),
        _n(critical & since_months(day, as_of, 6) & upto, "critical_six_months"),
    )


@query("q_sf_32", "Root causes within one incident type or division")
def causes_within(t: Tables, incident_type: str | None = "Equipment Failure", division: str | None = None) -> DataFrame:
    rows = t["incidents"]
    if incident_type:
        rows = rows.filter(F.col("incident_type") == incident_type)
    if division:
        rows = rows.filter(F.col("division") == division)
    return rows.groupBy("root_cause").agg(aggs.n_rows().alias("incidents"), _lost().alias("lost_days"))


@query("q_sf_33", "Two divisions compared")
def two_divisions(t: Tables, divisions: Sequence[str] = ("ASIA", "EUROPE")) -> DataFrame:
    return (
        t["incidents"]
        .filter(F.col("division").isin(*divisions))
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("incidents"),
            *aggs.status_counts("severity", SEVERITIES),
            _lti().alias("ltis"),
            _lost().alias("lost_days"),
            aggs.rate_pct(F.col("status") == "closed").alias("closed_pct"),
        )
    )


@query("q_sf_34", "Incidents under investigation")
def under_investigation(t: Tables, critical_only: bool = False) -> DataFrame:
    rows = t["incidents"].filter(F.col("status") == "investigating")
    if critical_only:
        rows = rows.filter(_sev() == "Critical")
    return rows.select(*BRIEF, "root_cause")


@query("q_sf_35", "Sites by lost-time injuries")
def sites_by_lti(t: Tables) -> DataFrame:
    return (
        t["incidents"]
        .groupBy("site_name")
        .agg(_lti().alias("lti_count"), _lost().alias("lti_days"))
        .orderBy(F.desc("lti_count"), F.desc("lti_days"), "site_name")
    )


@query("q_sf_36", "Rework cost by site")
def rework_by_site(t: Tables) -> DataFrame:
    return t["inspections"].filter(F.col("result") == "fail").groupBy("site_name").agg(
        aggs.n_rows().alias("failed"), rnd(aggs.total("rework_cost_aud", 4), 2).alias("rework_cost_aud")
    )


@query("q_sf_36_noise", "Noise exceedances by site in the last months")
def noise_exceedances(t: Tables, as_of: date = EVENT_DAY, months: int = 3) -> DataFrame:
    rows = t["emissions"].filter(
        (F.col("monitor_type") == "noise_db") & F.col("is_exceedance") & since_months("reading_date", as_of, months)
    )
    return rows.groupBy("site_name").agg(aggs.n_rows().alias("exceedances"))


@query("q_sf_37", "Improving trend but open critical incidents")
def improving_but_open(t: Tables) -> DataFrame:
    moved = month_over_month(t["safety_kpis"], ["division"], "month", "total_incidents")
    per = moved.groupBy("division").agg(
        F.max_by("trend", "month").alias("trend"),
        F.max_by("total_incidents", "month").alias("latest_incidents"),
        F.max_by("previous", "month").alias("previous_incidents"),
    )
    open_critical = t["incidents"].filter((_sev() == "Critical") & rules.is_open("status")).groupBy("division").agg(
        aggs.n_rows().alias("open_critical")
    )
    return per.filter(F.col("trend") == "falling").join(open_critical, "division")
