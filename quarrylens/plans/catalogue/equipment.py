"""Fleet health and maintenance questions.

Telemetry holds many readings per unit.  Published joins of work orders to readings repeat
each work order per reading; the repeats are counted through ``_readings`` instead of being
produced, and the ``*_safe`` forms count each work order once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import clamp, dec, pct, ratio, rnd
from quarrylens.functions.predicates import domain_rank, label, within_days
from quarrylens.functions.vocab import EQUIPMENT_STATUSES, IN_SERVICE
from quarrylens.operators.joins import join_left_agg, repeat_rows
from quarrylens.operators.latest import dedup_latest, latest_with_ties
from quarrylens.operators.windows import arg_max, ranked, share_of_group, top_k
from quarrylens.plans.catalogue.base import query
from quarrylens.sources.tables import Tables

AS_OF = date(2024, 1, 30)
UNIT = ["equipment_id", "equipment_type", "site_name", "division"]
TEMP = 3  # decimal places of temperatures and fuel rates


def _latest(t: Tables) -> DataFrame:
    return latest_with_ties(t["telemetry"], ["equipment_id"], "reading_timestamp")


def _status(value: str) -> Column:
    return aggs.count_where(F.col("status") == value)


def _retired() -> Column:
    return F.col("status") == "decommissioned"


def _work_by_model(t: Tables, keys: Sequence[str], safe: bool) -> DataFrame:
    """Work orders joined to the unit's distinct descriptions with the number of readings."""
    if safe:
        units = dedup_latest(t["telemetry"], ["equipment_id"], ["reading_timestamp", *keys]).select(
            "equipment_id", *keys, F.lit(1).cast("bigint").alias("_readings")
        )
    else:
        units = t["telemetry"].groupBy("equipment_id", *keys).agg(aggs.n_rows().alias("_readings"))
    return t["maintenance_log"].join(units, "equipment_id")


def _times(name: str, scale: int = 2) -> Column:
    """SUM of a measure over the row-level join."""
    return F.sum(dec(name, scale) * F.col("_readings").cast("decimal(12,0)")).cast("double")


@query("q_eq_01", "Critical and warning units, critical first")
def alerts(t: Tables, statuses: Sequence[str] = ("critical", "warning")) -> DataFrame:
    return (
        t["telemetry"]
        .filter(F.col("status").isin(*statuses))
        .select(*UNIT, "engine_temp_celsius", "fuel_level_pct", "status")
        .orderBy(domain_rank("status", EQUIPMENT_STATUSES), F.desc("engine_temp_celsius"), "equipment_id")
    )


@query("q_eq_02", "Status breakdown by division")
def status_by_division(t: Tables) -> DataFrame:
    return (
        t["telemetry"]
        .groupBy("division", "status")
        .agg(aggs.n_rows().alias("units"))
        .orderBy("division", domain_rank("status", EQUIPMENT_STATUSES))
    )


@query("q_eq_03", "Overdue maintenance")
def overdue(t: Tables, as_of: date = AS_OF) -> DataFrame:
    return (
        t["telemetry"]
        .filter(rules.overdue("maintenance_due_date", as_of))
        .select(*UNIT, "maintenance_due_date", "operating_hours", "status")
        .orderBy("maintenance_due_date", "equipment_id")
    )


@query("q_eq_04", "Average temperature and fuel by type")
def by_type(t: Tables) -> DataFrame:
    return (
        t["telemetry"]
        .groupBy("equipment_type")
        .agg(
            aggs.n_rows().alias("units"),
            aggs.avg_rounded("engine_temp_celsius", 1, TEMP).alias("avg_temp_c"),
            aggs.avg_rounded("fuel_level_pct", 1).alias("avg_fuel_pct"),
        )
        .orderBy(F.desc("avg_temp_c"), "equipment_type")
    )


@query("q_eq_05", "Low fuel")
def low_fuel(t: Tables, below: float = 20.0) -> DataFrame:
    return (
        t["telemetry"]
        .filter(F.col("fuel_level_pct") < below)
        .select("equipment_id", "equipment_type", "site_name", "fuel_level_pct", "status")
        .orderBy("fuel_level_pct", "equipment_id")
    )


@query("q_eq_06", "Most operating hours")
def most_hours(t: Tables, k: int = 20) -> DataFrame:
    columns = [*UNIT, "operating_hours", "status"]
    return top_k(t["telemetry"].select(*columns), [F.desc("operating_hours")], k, ["equipment_id", "status"])


@query("q_eq_07", "Latest reading of each unit")
def latest_readings(t: Tables) -> DataFrame:
    return (
        _latest(t)
        .select(
            "equipment_id",
            "equipment_type",
            "manufacturer",
            "site_name",
            "status",
            "engine_temp_celsius",
            "hydraulic_pressure_bar",
            "fuel_level_pct",
            "operating_hours",
            "maintenance_due_date",
        )
        .orderBy(domain_rank("status", EQUIPMENT_STATUSES), "equipment_id")
    )


@query("q_eq_08", "Maintenance cost by type and manufacturer")
def cost_by_model(t: Tables, safe: bool = False) -> DataFrame:
    done = F.col("status") == "completed"
    return (
        _work_by_model(t, ["equipment_type", "manufacturer"], safe)
        .filter(done)
        .groupBy("equipment_type", "manufacturer")
        .agg(
            aggs.distinct("work_order_id").alias("work_orders"),
            rnd(_times("cost_aud"), 2).alias("total_cost_aud"),
            rnd(_times("parts_cost_aud"), 2).alias("parts_aud"),
            rnd(_times("labour_cost_aud"), 2).alias("labour_aud"),
            rnd(_times("downtime_hours"), 1).alias("total_downtime_hrs"),
        )
        .orderBy(F.desc("total_cost_aud"), "equipment_type", "manufacturer")
    )


@query("q_eq_08_safe", "Maintenance cost by type and manufacturer, each order once")
def cost_by_model_safe(t: Tables) -> DataFrame:
    return cost_by_model(t, safe=True)


@query("q_eq_09", "Breakdown frequency and cost")
def breakdowns(t: Tables, safe: bool = False) -> DataFrame:
    n = F.sum("_readings")
    return (
        _work_by_model(t, ["manufacturer", "equipment_type"], safe)
        .filter(F.col("maintenance_type") == "breakdown")
        .groupBy("manufacturer", "equipment_type")
        .agg(
            n.alias("breakdowns"),
            rnd(_times("cost_aud"), 2).alias("breakdown_cost_aud"),
            rnd(ratio(_times("downtime_hours"), n), 1).alias("avg_downtime_hrs"),
            rnd(_times("downtime_hours"), 1).alias("total_downtime_hrs"),
        )
        .orderBy(F.desc("breakdowns"), "manufacturer", "equipment_type")
    )


@query("q_eq_09_safe", "Breakdown frequency and cost, each order once")
def breakdowns_safe(t: Tables) -> DataFrame:
    return breakdowns(t, safe=True)


@query("q_eq_10", "Overdue units with days overdue, from latest readings")
def days_overdue(t: Tables, as_of: date = AS_OF) -> DataFrame:
    return (
        _latest(t)
        .filter(rules.overdue("maintenance_due_date", as_of))
        .select(
            "equipment_id",
            "equipment_type",
            "manufacturer",
            "site_name",
            "maintenance_due_date",
            rules.days_overdue("maintenance_due_date", as_of).alias("days_overdue"),
        )
        .distinct()
        .orderBy(F.desc("days_overdue"), "equipment_id")
    )


@query("q_eq_11", "Cost by maintenance type")
def cost_by_kind(t: Tables) -> DataFrame:
    return (
        t["maintenance_log"]
        .filter(F.col("status") == "completed")
        .groupBy("maintenance_type")
        .agg(
            aggs.n_rows().alias("work_orders"),
            rnd(aggs.total("cost_aud"), 2).alias("total_cost_aud"),
            aggs.avg_rounded("cost_aud", 2).alias("avg_cost_aud"),
            rnd(aggs.total("downtime_hours"), 1).alias("total_downtime_hrs"),
            aggs.avg_rounded("downtime_hours", 1).alias("avg_downtime_hrs"),
        )
        .orderBy(F.desc("total_cost_aud"), "maintenance_type")
    )


_ORDER_COLUMNS = [
    "work_order_id",
    "equipment_id",
    "equipment_type",
    "manufacturer",
    "site_name",
    "maintenance_type",
    "description",
    "cost_aud",
    "parts_cost_aud",
    "labour_cost_aud",
    "downtime_hours",
]


def _priciest(t: Tables, k: int, safe: bool) -> DataFrame:
    log = t["maintenance_log"].filter(F.col("status") == "completed").drop("site_name", "division")
    best = top_k(log, [F.desc("cost_aud")], k, ["work_order_id"])
    keys = ["equipment_type", "manufacturer", "site_name"]
    if safe:
        units = dedup_latest(t["telemetry"], ["equipment_id"], ["reading_timestamp", *keys]).select("equipment_id", *keys)
        return best.join(units, "equipment_id")
    units = t["telemetry"].groupBy("equipment_id", *keys).agg(aggs.n_rows().alias("_readings"))
    return repeat_rows(best.join(units, "equipment_id"), "_readings", k)


@query("q_eq_12", "Most expensive work orders")
def priciest_orders(t: Tables, k: int = 10) -> DataFrame:
    """Published form: a work order shows once per reading of its unit, then the first k rows.

    Only orders whose unit reports telemetry count, hence the semi-join before the top k.
    """
    seen = t["maintenance_log"].join(t["telemetry"].select("equipment_id").distinct(), "equipment_id", "left_semi")
    rows = _priciest(t.with_tables(maintenance_log=seen), k, safe=False)
    return top_k(rows.select(*_ORDER_COLUMNS), [F.desc("cost_aud")], k, ["work_order_id", "site_name"])


@query("q_eq_12_safe", "Most expensive work orders, each once")
def priciest_orders_safe(t: Tables, k: int = 10) -> DataFrame:
    seen = t["maintenance_log"].join(t["telemetry"].select("equipment_id").distinct(), "equipment_id", "left_semi")
    return _priciest(t.with_tables(maintenance_log=seen), k, safe=True).select(*_ORDER_COLUMNS)


@query("q_eq_13", "Fuel consumption by type and manufacturer")
def fuel_by_model(t: Tables) -> DataFrame:
    return (
        t["telemetry"]
        .groupBy("equipment_type", "manufacturer")
        .agg(
            aggs.distinct("equipment_id").alias("fleet_count"),
            aggs.avg_rounded("fuel_consumption_lph", 1, TEMP).alias("avg_fuel_lph"),
            rnd(F.max("fuel_consumption_lph"), 1).alias("max_fuel_lph"),
            aggs.avg_rounded("fuel_level_pct", 1).alias("avg_fuel_level_pct"),
        )
        .orderBy(F.desc("avg_fuel_lph"), "equipment_type", "manufacturer")
    )


@query("q_eq_14", "Availability by site from latest readings")
def availability_by_site(t: Tables) -> DataFrame:
    units = aggs.distinct("equipment_id")
    return (
        _latest(t)
        .groupBy("site_name")
        .agg(
            units.alias("total_equipment"),
            _status("operational").alias("operational"),
            _status("warning").alias("warning"),
            _status("critical").alias("critical"),
            _status("maintenance").alias("in_maintenance"),
            rnd(pct(_status("operational"), units), 1).alias("availability_pct"),
        )
        .orderBy("availability_pct", "site_name")
    )


@query("q_eq_15", "Fleet status counts per division")
def status_counts(t: Tables) -> DataFrame:
    return t["telemetry"].groupBy("division").agg(
        aggs.n_rows().alias("total_units"), *aggs.status_counts("status", EQUIPMENT_STATUSES)
    )


@query("q_eq_16", "Fleet by division and type, without retired units")
def fleet_summary(t: Tables) -> DataFrame:
    return (
        t["telemetry"]
        .filter(~_retired())
        .groupBy("division", "equipment_type")
        .agg(
            aggs.n_rows().alias("total_units"),
            _status("operational").alias("active_units"),
            _status("maintenance").alias("in_maintenance"),
            _status("idle").alias("idle_units"),
            rnd(ratio(aggs.total_int("operating_hours"), F.count("operating_hours")), 0).alias("avg_operating_hours"),
            aggs.avg_rounded("engine_temp_celsius", 1, TEMP).alias("avg_engine_temp"),
        )
        .orderBy("division", F.desc("total_units"), "equipment_type")
    )


@query("q_eq_17", "Temperature alerts with level")
def temperature_alerts(t: Tables, status: str = "operational", warning_from: float = 105.0) -> DataFrame:
    return (
        t["telemetry"]
        .filter((F.col("engine_temp_celsius") > warning_from) & (F.col("status") == status))
        .select(
            *UNIT,
            "engine_temp_celsius",
            rules.temp_alert("engine_temp_celsius", warning_from).alias("alert_level"),
            "fuel_level_pct",
            "operating_hours",
            "status",
        )
        .orderBy(F.desc("engine_temp_celsius"), "equipment_id")
    )


@query("q_eq_18", "Overdue report with priority")
def overdue_report(t: Tables, as_of: date = AS_OF, statuses: Sequence[str] = ("operational", "idle")) -> DataFrame:
    due = "maintenance_due_date"
    return (
        t["telemetry"]
        .filter(rules.overdue(due, as_of) & F.col("status").isin(*statuses))
        .select(
            *UNIT,
            due,
            rules.days_overdue(due, as_of).alias("days_overdue"),
            rules.overdue_priority(due, as_of).alias("priority"),
            "operating_hours",
            "engine_temp_celsius",
            "status",
        )
        .orderBy(F.desc("days_overdue"), "equipment_id", "engine_temp_celsius")
    )


@query("q_eq_19", "Utilisation by division with overdue count")
def utilisation_by_division(t: Tables, as_of: date = AS_OF) -> DataFrame:
    return (
        t["telemetry"]
        .filter(~_retired())
        .groupBy("division")
        .agg(
            aggs.n_rows().alias("total_fleet"),
            _status("operational").alias("active_count"),
            aggs.rate_pct(F.col("status") == "operational").alias("utilisation_pct"),
            aggs.count_where(rules.overdue("maintenance_due_date", as_of)).alias("overdue_maintenance_count"),
        )
        .orderBy(F.desc("utilisation_pct"), "division")
    )


@query("q_eq_20", "Sites of one division")
def division_sites(t: Tables, division: str = "AMERICA", as_of: date = AS_OF) -> DataFrame:
    return (
        t["telemetry"]
        .filter((F.col("division") == division) & ~_retired())
        .groupBy("site_name")
        .agg(
            aggs.n_rows().alias("equipment_count"),
            _status("operational").alias("active"),
            aggs.count_where(F.col("engine_temp_celsius") > 105).alias("temp_alerts"),
            aggs.count_where(rules.overdue("maintenance_due_date", as_of)).alias("overdue_maintenance"),
            aggs.avg_rounded("fuel_level_pct", 1).alias("avg_fuel_level"),
        )
        .orderBy(F.desc("equipment_count"), "site_name")
    )


@query("q_eq_21", "Fleet KPI dashboard")
def fleet_dashboard(t: Tables) -> DataFrame:
    return t["fleet_kpis"].orderBy(F.desc("availability_pct"), "division")


@query("q_eq_21_breakdowns", "Divisions with breakdowns")
def breakdown_leaders(t: Tables) -> DataFrame:
    return t["fleet_kpis"].filter(F.col("breakdown_count") > 0).orderBy(F.desc("breakdown_count"), "division")


@query("q_eq_22", "Equipment benchmarks: critical readings and units")
def critical_counts(t: Tables) -> DataFrame:
    return t["telemetry"].filter(F.col("status") == "critical").agg(
        aggs.n_rows().alias("critical_readings"), aggs.distinct("equipment_id").alias("critical_units")
    )


@query("q_eq_22_breakdown", "Total breakdown cost and average downtime")
def breakdown_totals(t: Tables) -> DataFrame:
    return t["maintenance_log"].filter(F.col("maintenance_type") == "breakdown").agg(
        rnd(aggs.total("cost_aud"), 2).alias("breakdown_cost_aud"),
        aggs.avg_rounded("downtime_hours", 1).alias("avg_downtime_hrs"),
    )


@query("q_eq_22_maker", "Manufacturer with the most breakdowns")
def top_breakdown_maker(t: Tables) -> DataFrame:
    per = (
        _work_by_model(t, ["manufacturer"], safe=False)
        .filter(F.col("maintenance_type") == "breakdown")
        .groupBy("manufacturer")
        .agg(F.sum("_readings").alias("cnt"))
    )
    return arg_max(per, "cnt", "manufacturer")


@query("q_eq_22_due", "Units due for maintenance this week")
def due_this_week(t: Tables, as_of: date = AS_OF, days: int = 7) -> DataFrame:
    return (
        t["telemetry"]
        .filter(within_days("maintenance_due_date", as_of, days))
        .select("equipment_id", "equipment_type", "site_name", "maintenance_due_date")
        .distinct()
    )


@query("q_eq_23", "Maintenance cost per operating hour")
def cost_per_hour(t: Tables) -> DataFrame:
    hours = t["telemetry"].groupBy("equipment_id", "equipment_type").agg(F.max("operating_hours").alias("operating_hours"))
    work = t["maintenance_log"].groupBy("equipment_id").agg(aggs.total("cost_aud").alias("cost_aud"))
    return join_left_agg(hours, [work], ["equipment_id"]).select(
        "equipment_id",
        "equipment_type",
        "operating_hours",
        F.coalesce("cost_aud", F.lit(0.0)).alias("cost_aud"),
        rnd(ratio(F.coalesce("cost_aud", F.lit(0.0)), "operating_hours"), 2).alias("cost_per_hour"),
    )


@query("q_eq_24", "Hydraulic pressure outside the normal range")
def hydraulic_alerts(t: Tables) -> DataFrame:
    band = rules.hydraulic_band("hydraulic_pressure_bar")
    return (
        t["telemetry"]
        .withColumn("pressure_band", band)
        .filter(F.col("pressure_band").isin("warning", "critical"))
        .select("equipment_id", "site_name", "hydraulic_pressure_bar", "pressure_band")
    )


@query("q_eq_25", "Highest failure risk with past equipment incidents at the site")
def failure_risk(t: Tables, as_of: date = AS_OF, k: int = 10) -> DataFrame:
    """Our definition, 0-100: hours up to 20,000 h (40), temperature 70-130 C (40), overdue (20)."""
    hot = clamp(F.col("engine_temp_celsius") - 70.0, 0.0, 60.0) / 60.0 * 40.0
    worn = clamp(F.col("operating_hours").cast("double") / 20000.0, 0.0, 1.0) * 40.0
    late = F.when(rules.overdue("maintenance_due_date", as_of), F.lit(20.0)).otherwise(F.lit(0.0))
    failures = t["incidents"].filter(F.col("incident_type") == "Equipment Failure").groupBy("site_name").agg(
        aggs.n_rows().alias("site_equipment_incidents")
    )
    scored = _latest(t).withColumn("failure_score", rnd(worn + hot + late, 1))
    worst = top_k(scored, [F.desc("failure_score")], k, ["equipment_id"])
    return worst.join(failures, "site_name", "left").select(
        "equipment_id",
        "equipment_type",
        "site_name",
        "status",
        "operating_hours",
        "engine_temp_celsius",
        "failure_score",
        F.coalesce("site_equipment_incidents", F.lit(0)).alias("site_equipment_incidents"),
    )


@query("q_eq_26", "Units of one type by hours")
def units_of_type(t: Tables, equipment_type: str = "excavator") -> DataFrame:
    return (
        _latest(t)
        .filter(F.col("equipment_type") == equipment_type)
        .select("equipment_id", "site_name", "operating_hours", "status")
        .orderBy(F.desc("operating_hours"), "equipment_id")
    )


@query("q_eq_27", "Units per division, and active ones")
def units_per_division(t: Tables) -> DataFrame:
    return _latest(t).groupBy("division").agg(
        aggs.distinct("equipment_id").alias("units"),
        F.countDistinct(F.when(F.col("status") == "operational", F.col("equipment_id"))).alias("active_units"),
    )


@query("q_eq_28", "Sites with the most warning or critical units")
def alert_sites(t: Tables, k: int = 10) -> DataFrame:
    per = (
        _latest(t)
        .filter(F.col("status").isin("warning", "critical"))
        .groupBy("site_name")
        .agg(aggs.distinct("equipment_id").alias("alert_units"))
    )
    return top_k(per, [F.desc("alert_units")], k, ["site_name"])


@query("q_eq_29", "Fleet status share")
def status_share(t: Tables) -> DataFrame:
    counted = _latest(t).groupBy("division", "status").agg(aggs.n_rows().alias("units"))
    return share_of_group(counted, ["division"], "units", "_s").withColumn("share_pct", rnd("_s", 1)).drop("_s")


@query("q_eq_30", "Low fuel while in service")
def low_fuel_in_service(t: Tables, below: float = 10.0) -> DataFrame:
    return (
        t["telemetry"]
        .filter(rules.low_fuel("fuel_level_pct", "status", below))
        .select("equipment_id", "site_name", "fuel_level_pct", "status")
    )


@query("q_eq_31", "All units of one site with health readings")
def site_units(t: Tables, site: str = "NATION_7") -> DataFrame:
    return (
        _latest(t)
        .filter(F.col("site_name") == site)
        .select(
            "equipment_id",
            "equipment_type",
            "status",
            "engine_temp_celsius",
            "fuel_level_pct",
            rules.fuel_band("fuel_level_pct").alias("fuel_band"),
            rules.hydraulic_band("hydraulic_pressure_bar").alias("pressure_band"),
            rules.service_due("operating_hours").alias("service_due"),
        )
    )


@query("q_eq_32", "Divisions by availability and overdue units")
def division_ranking(t: Tables, as_of: date = AS_OF) -> DataFrame:
    per = _latest(t).groupBy("division").agg(
        aggs.rate_pct(F.col("status") == "operational").alias("availability_pct"),
        aggs.count_where(rules.overdue("maintenance_due_date", as_of) & F.col("status").isin(*IN_SERVICE)).alias("overdue_units"),
    )
    by_availability = ranked(per, "availability_pct", desc=False, out="availability_rank")
    by_overdue = ranked(per.select("division", "overdue_units"), "overdue_units", out="overdue_rank")
    return by_availability.drop("overdue_units").join(by_overdue, "division")


@query("q_eq_33", "Maintenance cost and downtime by manufacturer, each order once")
def cost_by_maker(t: Tables) -> DataFrame:
    return _work_by_model(t, ["manufacturer"], safe=True).groupBy("manufacturer").agg(
        rnd(aggs.total("cost_aud"), 2).alias("cost_aud"),
        rnd(aggs.total("downtime_hours"), 1).alias("downtime_hrs"),
        aggs.n_rows().alias("work_orders"),
    )


@query("q_eq_34", "Mean time between failures and to repair by type")
def mtbf_mttr(t: Tables) -> DataFrame:
    hours = (
        t["telemetry"]
        .groupBy("equipment_type", "equipment_id")
        .agg(F.max("operating_hours").alias("h"))
        .groupBy("equipment_type")
        .agg(aggs.total_int("h").alias("operating_hours"))
    )
    down = (
        _work_by_model(t, ["equipment_type"], safe=True)
        .filter(F.col("maintenance_type") == "breakdown")
        .groupBy("equipment_type")
        .agg(aggs.n_rows().alias("breakdowns"), aggs.total("downtime_hours").alias("downtime_hours"))
    )
    return hours.join(down, "equipment_type", "left").select(
        "equipment_type",
        "operating_hours",
        F.coalesce("breakdowns", F.lit(0)).alias("breakdowns"),
        rnd(rules.mtbf("operating_hours", "breakdowns"), 1).alias("mtbf_hours"),
        rnd(rules.mttr("downtime_hours", "breakdowns"), 1).alias("mttr_hours"),
    )


@query("q_eq_35", "Readings per temperature, fuel and pressure band")
def band_counts(t: Tables) -> DataFrame:
    alert = F.coalesce(rules.temp_alert("engine_temp_celsius", 95.0), F.lit("NORMAL"))
    return t["telemetry"].groupBy(
        alert.alias("temperature"),
        rules.fuel_band("fuel_level_pct").alias("fuel"),
        rules.hydraulic_band("hydraulic_pressure_bar").alias("pressure"),
        label([(rules.in_service("status"), "in_service")], "out_of_service").alias("service"),
    ).agg(aggs.n_rows().alias("readings"))
