"""KPI tables, semantic measures and the analytical views described without SQL.

Formulas marked "our definition" have no published text behind them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import clamp, dec, exact, pct, ratio, rnd
from quarrylens.functions.predicates import label, month_start
from quarrylens.functions.vocab import EQUIPMENT_STATUSES, SEVERITIES, SUPPLY_RISK
from quarrylens.operators.joins import full_on, join_left_agg
from quarrylens.operators.latest import last_per_entity, latest_snapshot, latest_with_ties
from quarrylens.operators.windows import share_of_group

MONEY = 4  # decimal places kept in financial sums


# --- KPI tables -------------------------------------------------------------


def project_kpis(fin: DataFrame) -> DataFrame:
    return latest_snapshot(fin).groupBy("division").agg(
        aggs.total("budget_aud", MONEY).alias("total_budget"),
        aggs.total("actual_cost_aud", MONEY).alias("total_actual_cost"),
        aggs.avg_rounded("cpi", 3, 4).alias("avg_cpi"),
        aggs.avg_rounded("spi", 3, 4).alias("avg_spi"),
        aggs.n_rows().alias("project_count"),
        aggs.count_where(F.col("status") == "red").alias("red_projects"),
    )


def safety_kpis(inc: DataFrame) -> DataFrame:
    return inc.groupBy("division", month_start("incident_date").alias("month")).agg(
        aggs.n_rows().alias("total_incidents"),
        aggs.count_where(F.col("is_near_miss")).alias("near_misses"),
        aggs.count_where(rules.is_lti("lost_time_days")).alias("ltis"),
        aggs.total("lost_time_days").alias("lost_time_days"),
    )


def fleet_kpis(tel: DataFrame, log: DataFrame) -> DataFrame:
    units = latest_with_ties(tel, ["equipment_id"], "reading_timestamp").groupBy("division").agg(
        aggs.distinct("equipment_id").alias("total_equipment"),
        aggs.count_where(F.col("status") == "operational").alias("operational_count"),
    )
    work = log.groupBy("division").agg(
        aggs.total("cost_aud").alias("total_maintenance_cost"),
        aggs.count_where(F.col("maintenance_type") == "breakdown").alias("breakdown_count"),
    )
    return join_left_agg(units, [work], ["division"]).select(
        "division",
        "total_equipment",
        "operational_count",
        rnd(pct("operational_count", "total_equipment"), 1).alias("availability_pct"),
        F.coalesce("total_maintenance_cost", F.lit(0.0)).alias("total_maintenance_cost"),
        F.coalesce("breakdown_count", F.lit(0)).alias("breakdown_count"),
    )


def division_summary(fin: DataFrame, tel: DataFrame, log: DataFrame, inc: DataFrame, em: DataFrame) -> DataFrame:
    fleet = fleet_kpis(tel, log).select(
        "division", F.col("total_equipment").alias("fleet_count"), F.col("availability_pct").alias("fleet_operational_pct")
    )
    hurt = inc.groupBy("division").agg(aggs.n_rows().alias("incident_count"))
    over = em.groupBy("division").agg(aggs.count_where(F.col("is_exceedance")).alias("exceedance_count"))
    joined = join_left_agg(project_kpis(fin), [fleet, hurt, over], ["division"])
    return joined.na.fill(0, ["fleet_count", "incident_count", "exceedance_count"])


def monthly_kpis(fin: DataFrame, inc: DataFrame, insp: DataFrame, em: DataFrame) -> DataFrame:
    money = fin.groupBy("division", month_start("reporting_period").alias("month")).agg(
        aggs.total("budget_aud", MONEY).alias("budget_aud"), aggs.total("actual_cost_aud", MONEY).alias("actual_cost_aud")
    )
    hurt = safety_kpis(inc).select("division", "month", F.col("total_incidents").alias("incidents"), "near_misses", "lost_time_days")
    checks = insp.groupBy("division", month_start("inspection_date").alias("month")).agg(
        aggs.count_where(F.col("result") == "pass").alias("inspections_passed"),
        aggs.count_where(F.col("result") == "fail").alias("inspections_failed"),
    )
    over = em.groupBy("division", month_start("reading_date").alias("month")).agg(
        aggs.count_where(F.col("is_exceedance")).alias("exceedances")
    )
    keys = ["division", "month"]
    out = full_on(full_on(full_on(money, hurt, keys), checks, keys), over, keys)
    return out.na.fill(0)


def exec_scorecard(lines: DataFrame, contracts: DataFrame) -> DataFrame:
    """Supplier x category card.  Our definition of quality: 5 * (1 - 1.2 * rejected share), at least 1."""
    card = lines.groupBy("supplier_name", "category").agg(
        aggs.total("amount_aud").alias("total_spend_aud"),
        aggs.rate_pct(F.col("on_time")).alias("on_time_delivery_pct"),
        aggs.n_rows().alias("_n"),
        aggs.count_where(F.col("rejected")).alias("_bad"),
        F.max("day").alias("last_review_date"),
    )
    quality = F.greatest(F.lit(1.0), rnd(F.lit(5.0) - ratio("_bad", "_n") * 6.0, 2))
    return card.join(contracts, "supplier_name", "left").select(
        "supplier_name",
        "division",
        "category",
        "total_spend_aud",
        "on_time_delivery_pct",
        quality.alias("quality_score"),
        "contract_status",
        "last_review_date",
    )


# --- semantic measures ------------------------------------------------------


def portfolio_health(kpis: DataFrame) -> DataFrame:
    """Plain average over rows of (avg CPI + avg SPI) / 2."""
    half = (dec("avg_cpi", 3) + dec("avg_spi", 3)) / 2
    return kpis.agg(rnd(aggs.mean(half, 4), 4).alias("portfolio_health_score"))


def fleet_availability(kpis: DataFrame) -> DataFrame:
    return kpis.agg(rnd(aggs.mean("availability_pct", 1), 2).alias("fleet_availability_pct"))


def incidents_mtd(kpis: DataFrame, as_of: date, measure: str = "total_incidents") -> DataFrame:
    """Total from the first of the month of ``as_of`` to ``as_of``."""
    inside = F.col("month").between(F.lit(as_of.replace(day=1)), F.lit(as_of))
    return kpis.filter(inside).agg(F.coalesce(F.sum(measure), F.lit(0)).alias("incidents_mtd"))


# --- views ------------------------------------------------------------------


def project_risk_matrix(
    fin: DataFrame,
    milestones: DataFrame,
    inc: DataFrame,
    mat: DataFrame,
    cuts: Sequence[float] = (20.0, 35.0, 50.0),
) -> DataFrame:
    """0-100 score per project at its newest snapshot.  Our definition:

    cost 0-40 (400 points per unit of CPI below 1), schedule 0-30 (share of delayed
    milestones), safety 0-20 (critical share of incidents at the project's site, in
    percent), supply 0-10 (share of risk materials).
    """
    now = last_per_entity(fin, ["project_id"])
    late = milestones.groupBy("project_id").agg(
        aggs.n_rows().alias("_milestones"), aggs.count_where(F.col("status") == "delayed").alias("_delayed")
    )
    hurt = inc.groupBy(F.col("site_name").alias("state")).agg(
        aggs.n_rows().alias("_incidents"), aggs.count_where(F.col("severity") == "Critical").alias("critical_incidents")
    )
    supply = mat.groupBy("project_id").agg(
        aggs.n_rows().alias("_materials"), aggs.count_where(F.col("availability").isin(*SUPPLY_RISK)).alias("_risky")
    )
    share = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))
    score = (
        F.coalesce(clamp((F.lit(1.0) - F.col("cpi")) * 400.0, 0.0, 40.0), F.lit(0.0))
        + share("_delayed", "_milestones") * 30.0
        + clamp(share("critical_incidents", "_incidents") * 100.0, 0.0, 20.0)
        + share("_risky", "_materials") * 10.0
    )
    low, medium, high = cuts
    s = F.col("risk_score")
    return (
        now.join(late, "project_id", "left")
        .join(supply, "project_id", "left")
        .join(hurt, "state", "left")
        .withColumn("risk_score", rnd(score, 1))
        .select(
            "project_id",
            "project_name",
            "division",
            "risk_score",
            label([(s >= high, "Critical"), (s >= medium, "High"), (s >= low, "Medium")], "Low").alias("risk_rating"),
            rnd(pct("actual_cost_aud", "budget_aud"), 1).alias("cost_utilisation_pct"),
            F.coalesce("critical_incidents", F.lit(0)).alias("critical_incidents"),
        )
    )


def financials_by_division(fin: DataFrame) -> DataFrame:
    return fin.groupBy("division").agg(
        aggs.distinct("project_id").alias("projects"),
        aggs.total("budget_aud", MONEY).alias("total_budget"),
        aggs.total("actual_cost_aud", MONEY).alias("total_actual_cost"),
        aggs.avg_rounded("spi", 3, 4).alias("avg_spi"),
        aggs.avg_rounded("cpi", 3, 4).alias("avg_cpi"),
        aggs.count_where(F.col("actual_cost_aud") > F.col("budget_aud")).alias("over_budget"),
    )


def safety_summary(inc: DataFrame) -> DataFrame:
    return inc.groupBy("site_name", "division").agg(
        aggs.n_rows().alias("incidents"),
        *aggs.status_counts("severity", SEVERITIES, "_incidents"),
        aggs.total("lost_time_days").alias("lti_days"),
        aggs.rate_pct(F.col("status") == "closed").alias("completion_rate_pct"),
    )


def equipment_status(tel: DataFrame, log: DataFrame) -> DataFrame:
    work = log.groupBy("equipment_id").agg(
        aggs.n_rows().alias("work_orders"),
        aggs.total("cost_aud").alias("maintenance_cost_aud"),
        aggs.total("downtime_hours").alias("downtime_hours"),
        F.max("work_date").alias("last_work_date"),
    )
    now = latest_with_ties(tel, ["equipment_id"], "reading_timestamp")
    return now.join(work, "equipment_id", "left").select(
        "equipment_id",
        "equipment_type",
        "manufacturer",
        "site_name",
        "division",
        "status",
        "engine_temp_celsius",
        "fuel_level_pct",
        "operating_hours",
        "maintenance_due_date",
        F.coalesce("work_orders", F.lit(0)).alias("work_orders"),
        F.coalesce("maintenance_cost_aud", F.lit(0.0)).alias("maintenance_cost_aud"),
        F.coalesce("downtime_hours", F.lit(0.0)).alias("downtime_hours"),
        "last_work_date",
    )


def procurement_analytics(mat: DataFrame) -> DataFrame:
    """Supplier x category: spend share, lead-time spread, price volatility, supply risk.

    Rows are first hashed down to (supplier, category, lead time), so the exact median works
    on counted days and a hot supplier is combined early.  Volatility is the population
    deviation over the mean, from exact sums.
    """
    price = F.col("unit_price_aud").cast("decimal(12,2)")
    per_lead = mat.groupBy("supplier", "category", "lead_time_days").agg(
        aggs.n_rows().alias("_n"),
        F.sum(exact("total_cost_aud")).alias("_cost"),
        F.count("unit_price_aud").alias("_n_price"),
        F.sum(exact("unit_price_aud")).alias("_price"),
        F.sum(price * price).alias("_price2"),
        aggs.count_where(F.col("availability").isin(*SUPPLY_RISK)).alias("_risky"),
    )
    per = per_lead.groupBy("supplier", "category").agg(
        F.sum("_n").alias("materials"),
        F.sum("_cost").alias("_spend"),
        F.min("lead_time_days").alias("min_lead_days"),
        F.percentile("lead_time_days", 0.5, F.col("_n")).alias("median_lead_days"),
        F.max("lead_time_days").alias("max_lead_days"),
        ratio(F.sum("_price"), F.sum("_n_price")).alias("_mean"),
        ratio(F.sum("_price2"), F.sum("_n_price")).alias("_square"),
        F.sum("_risky").alias("supply_risk_items"),
    )
    spread = F.sqrt(F.greatest(F.col("_square") - F.col("_mean") * F.col("_mean"), F.lit(0.0)))
    return share_of_group(per, ["category"], "_spend", "_share").select(
        "supplier",
        "category",
        "materials",
        F.col("_spend").cast("double").alias("total_spend_aud"),
        rnd("_share", 1).alias("category_share_pct"),
        "min_lead_days",
        "median_lead_days",
        "max_lead_days",
        rnd(ratio(spread, "_mean"), 4).alias("price_volatility"),
        "supply_risk_items",
    )


def workforce_utilisation(ts: DataFrame) -> DataFrame:
    hours = dec("hours_regular") + dec("hours_overtime")
    return ts.groupBy("site_name").agg(
        aggs.distinct("employee_id").alias("headcount"),
        aggs.total(hours).alias("total_hours"),
        rnd(aggs.weighted_ratio("hours_overtime", hours) * 100.0, 1).alias("overtime_pct"),
        aggs.total("total_cost_aud", 4).alias("labour_cost_aud"),
        aggs.count_where(~F.col("is_inducted")).alias("uninducted_shifts"),
    )


def compliance_dashboard(em: DataFrame) -> DataFrame:
    return em.groupBy("site_name", "monitor_type").agg(
        aggs.n_rows().alias("readings"),
        aggs.count_where(F.col("is_exceedance")).alias("exceedances"),
        aggs.rate_pct(F.col("is_exceedance")).alias("exceedance_rate_pct"),
        F.max("measurement_value").alias("max_reading"),
    )
