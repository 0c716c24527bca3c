"""Operations tables derived from the order / event tables we are given.

Only a stand-in for a site's own tables: every builder is ``Tables -> DataFrame`` over the
parquet inputs and any of them can be replaced in the registry by a real table.

Sites are nations and divisions are regions.  Line items are summed per order before they
are joined, so an order holding a large part of all lines is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import dec, rnd
from quarrylens.functions.predicates import label
from quarrylens.operators.latest import dedup_latest
from quarrylens.operators.partitions import dealt
from quarrylens.sources.tables import Tables

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Fixed values.
EQUIPMENT_TYPES = ("haul_truck", "excavator", "drill", "loader", "dozer", "grader", "water_cart", "crane")
VEHICLE_TYPES = ("haul_truck", "excavator", "loader", "crane")
MANUFACTURERS = ("Maker A", "Maker B", "Maker C", "Maker D", "Maker E")
INCIDENT_TYPES = (
    "Slip/Trip/Fall",
    "Vehicle Interaction",
    "Equipment Failure",
    "Falling Object",
    "Chemical Exposure",
    "Heat Stress",
    "Noise Exposure",
    "Confined Space",
    "Electrical",
    "Struck By",
    "Near Miss",
    "Working at Height",
)
ROOT_CAUSES = (
    "human_error",
    "equipment_failure",
    "procedural",
    "environmental",
    "design",
    "poor_housekeeping",
    "inadequate_training",
)
ROLES = ("operator", "engineer", "supervisor", "labourer")
MONITORS = ("dust_pm10", "dust_pm2_5", "noise_db", "water_ph")
MONITOR_UNITS = ("ug/m3", "ug/m3", "dB", "pH")


def pick(key: Column, words: tuple[str, ...]) -> Column:
    """words[key % len(words)]."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (key % len(words)).cast("int") + 1)


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def sites(t: Tables) -> DataFrame:
    """Nation and region of a site: a dimension of a few rows."""
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("site_name"), F.col("r_name").alias("division")
    )


def site_lookup(t: Tables) -> DataFrame:
    """Sites for joins; the planner sends them to the tasks while they are within its limit."""
    return t["sites"]


def site_events(t: Tables) -> DataFrame:
    ev = t["events"].select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    return ev.join(t["site_lookup"], F.col("user_id") % 25 == F.col("n_nationkey")).drop("n_nationkey")


def supplier_sites(t: Tables) -> DataFrame:
    return t["supplier"].join(t["site_lookup"], F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_name", "s_nationkey", "site_name", "division"
    )


def customer_sites(t: Tables) -> DataFrame:
    return t["customer"].join(t["site_lookup"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "site_name", "division"
    )


# --- supply-chain feeds -----------------------------------------------------


def gps_pings(t: Tables) -> DataFrame:
    return t["site_events"].select(
        _text("event_id").alias("ping_id"),
        F.concat(F.lit("V-"), _text("user_id")).alias("vehicle_id"),
        pick(F.col("user_id"), VEHICLE_TYPES).alias("vehicle_type"),
        "site_name",
        (F.lit(-5.0) - F.col("k") * 0.5).alias("latitude"),
        (F.lit(105.0) + F.col("event_id") % 60).alias("longitude"),
        (F.col("value") - 5.0).alias("speed_kmh"),
        (F.col("event_id") % 360).cast("double").alias("heading_degrees"),
        (F.col("event_type") != "signup").alias("engine_on"),
        F.col("k").cast("double").alias("fuel_level_pct"),
        F.col("ts").alias("ping_timestamp"),
        _text(F.to_date("ts")).alias("batch_id"),
        F.col("ts").alias("_ingested_at"),
        F.lit("events").alias("_source_file"),
    )


def delivery_receipts(t: Tables) -> DataFrame:
    lines = t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    ordered = t["orders"].select("o_orderkey", "o_custkey").join(
        t["customer_sites"].select("c_custkey", F.col("site_name").alias("destination_site")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    goods = (
        lines.join(ordered.select("o_orderkey", "destination_site"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["part"].select("p_partkey", "p_type", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    )
    surcharge = F.when(F.col("l_tax") > 0.075, F.lit("1.05")).otherwise(F.lit("1.00")).cast("decimal(3,2)")
    returned, open_line = F.col("l_returnflag"), F.col("l_linestatus") == "O"
    return goods.select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("delivery_id"),
        F.col("s_name").alias("supplier"),
        F.col("p_type").alias("material"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.lit("unit").alias("unit"),
        F.col("p_retailprice").alias("unit_price"),
        (dec("p_retailprice") * F.col("l_quantity").cast("decimal(10,0)") * surcharge).cast("double").alias("total_cost"),
        "destination_site",
        F.lit("WH-0").alias("warehouse_origin"),
        _text("l_orderkey").alias("po_number"),
        _text(F.to_date("l_shipdate")).alias("delivery_date"),
        F.lit("site store").alias("received_by"),
        F.when(returned == "N", "good")
        .when((returned == "A") & ~open_line, "partial")
        .when(returned == "A", "good")
        .when((returned == "R") & ~open_line, "damaged")
        .alias("condition"),
        _text(F.year("l_shipdate")).alias("batch_id"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.lit("lineitem").alias("_source_file"),
        # kept for the total order of the dedup
        F.col("l_partkey").alias("_partkey"),
        F.col("l_suppkey").alias("_suppkey"),
        F.col("l_extendedprice").alias("_price"),
        F.col("l_discount").alias("_discount"),
        F.col("l_tax").alias("_tax"),
    )


DELIVERY_ORDER = ("_ingested_at", "_partkey", "_suppkey", "_price", "_discount", "_tax", "quantity")


def supplier_invoices(t: Tables) -> DataFrame:
    per_order = t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("suppkey"), F.count(F.lit(1)).cast("int").alias("line_items")
    )
    bills = (
        t["orders"]
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t["supplier"].select("s_suppkey", "s_name"), F.col("suppkey") == F.col("s_suppkey"))
        .join(t["customer_sites"].select("c_custkey", "site_name"), F.col("o_custkey") == F.col("c_custkey"))
    )
    subtotal = dec("o_totalprice")
    extra = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(5)).otherwise(F.lit(0)).cast("decimal(3,0)")
    gst = subtotal * F.lit("0.1").cast("decimal(2,1)") + extra
    day = F.to_date("o_orderdate")
    return bills.select(
        _text("o_orderkey").alias("invoice_id"),
        F.col("s_name").alias("supplier"),
        _text("o_orderkey").alias("po_number"),
        _text(day).alias("invoice_date"),
        _text(F.date_add(day, 30)).alias("due_date"),
        "line_items",
        F.col("o_totalprice").alias("subtotal_aud"),
        gst.cast("double").alias("gst_aud"),
        (subtotal + gst).cast("double").alias("total_aud"),
        F.lit("AUD").alias("currency"),
        F.when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .when(F.col("o_orderpriority") == "5-LOW", "disputed")
        .otherwise("approved")
        .alias("payment_status"),
        F.col("site_name").alias("site"),
        _text(F.year("o_orderdate")).alias("batch_id"),
        F.col("o_orderdate").alias("_ingested_at"),
        F.lit("orders").alias("_source_file"),
    )


def warehouse_stock(t: Tables) -> DataFrame:
    # Lines are summed per (supplier, part, year) first: the joins then see far fewer rows.
    lines = t["lineitem"].groupBy("l_suppkey", "l_partkey", F.year("l_shipdate").alias("yr")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.to_date("l_shipdate")).alias("last_day"),
    )
    stock = (
        lines.join(t["supplier_sites"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("s_nationkey", "site_name", "division", "p_type", "yr")
        .agg(F.sum("qty").alias("qty"), F.sum("n_lines").alias("n_lines"), F.max("last_day").alias("last_day"))
    )
    on_hand = (F.col("qty") % 1500 - 50).cast("int")
    reorder = (100 + F.col("n_lines") % 400).cast("int")
    return stock.select(
        F.concat(F.lit("WH-"), _text("s_nationkey")).alias("warehouse_id"),
        F.concat("site_name", F.lit(" Depot")).alias("warehouse_name"),
        F.col("division").alias("region"),
        F.col("p_type").alias("material"),
        on_hand.alias("on_hand_qty"),
        reorder.alias("reorder_point"),
        F.lit("unit").alias("unit"),
        (on_hand < reorder).alias("below_reorder"),
        _text("last_day").alias("last_replenished"),
        _text("last_day").alias("snapshot_timestamp"),
        _text("yr").alias("batch_id"),
        F.col("last_day").alias("_ingested_at"),
        F.lit("lineitem").alias("_source_file"),
    )


# --- projects ---------------------------------------------------------------


def order_values(t: Tables) -> DataFrame:
    """Planned, earned, actual and budgeted value of each order."""
    price, disc, tax = dec("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    rate = lambda text: F.lit(text).cast("decimal(3,2)")
    return t["lineitem"].groupBy("l_orderkey").agg(
        F.sum(price * rate("0.95")).alias("pv"),
        F.sum(price * (rate("1.00") - disc)).alias("ev"),
        F.sum(price * (rate("0.91") + tax)).alias("ac"),
        F.sum(price * rate("0.96")).alias("bac"),
    )


def financials(t: Tables) -> DataFrame:
    wide = lambda c: F.sum(F.col(c).cast("decimal(30,4)")).cast("double")
    day = F.to_date("o_orderdate")
    per_project = (
        t["orders"]
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(t["order_values"], F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
        .agg(
            wide("bac").alias("budget_aud"),
            wide("ac").alias("actual_cost_aud"),
            wide("ev").alias("earned_value_aud"),
            wide("pv").alias("planned_value_aud"),
            F.min(day).alias("start_date"),
            F.date_add(F.max(day), 400).alias("planned_completion"),
        )
    )
    spi = rnd(rules.spi("earned_value_aud", "planned_value_aud"), 4)
    cpi = rnd(rules.cpi("earned_value_aud", "actual_cost_aud"), 4)
    low = F.least(F.col("spi"), F.col("cpi"))
    return (
        per_project.join(t["customer_sites"], F.col("o_custkey") == F.col("c_custkey"))
        .withColumns(
            {
                "spi": spi,
                "cpi": cpi,
                "cost_variance_pct": rnd(rules.cv_pct("earned_value_aud", "actual_cost_aud"), 2),
                "schedule_variance_pct": rnd(rules.sv_pct("earned_value_aud", "planned_value_aud"), 2),
                "pct_complete": rnd(rules.ratio("earned_value_aud", "budget_aud") * 100.0, 1),
            }
        )
        .select(
            _text("o_custkey").alias("project_id"),
            F.col("c_name").alias("project_name"),
            "division",
            F.concat(F.lit("Client "), F.col("c_mktsegment")).alias("client"),
            F.col("c_mktsegment").alias("project_type"),
            F.col("site_name").alias("state"),
            "budget_aud",
            "actual_cost_aud",
            "earned_value_aud",
            "planned_value_aud",
            "cost_variance_pct",
            "schedule_variance_pct",
            "spi",
            "cpi",
            label([(low < 0.95, "red"), (low < 1.0, "amber")], "green").alias("status"),
            "start_date",
            "planned_completion",
            F.make_date("yr", F.lit(1), F.lit(1)).alias("reporting_period"),
            F.concat(F.lit("PM-"), _text(F.col("c_custkey") % 20)).alias("project_manager"),
            "pct_complete",
        )
    )


def milestones(t: Tables) -> DataFrame:
    shipped = t["lineitem"].groupBy("l_orderkey").agg(F.max(F.to_date("l_shipdate")).alias("actual_date"))
    planned = F.to_date("o_orderdate")
    forecast = F.date_add(planned, 45)
    delay = F.datediff(F.col("actual_date"), forecast)
    return t["orders"].join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("M-"), _text("o_orderkey")).alias("milestone_id"),
        _text("o_custkey").alias("project_id"),
        F.concat(F.lit("Milestone "), _text("o_orderkey")).alias("milestone_name"),
        planned.alias("planned_date"),
        forecast.alias("forecast_date"),
        "actual_date",
        pick(F.col("o_orderkey"), ("design", "construction", "handover")).alias("milestone_type"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_critical_path"),
        label([(delay > 30, "delayed"), (delay > 0, "at_risk")], "on_track").alias("status"),
        delay.cast("bigint").alias("delay_days"),
    )


def inspections(t: Tables) -> DataFrame:
    lines = (
        t["lineitem"]
        .join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["supplier_sites"], F.col("l_suppkey") == F.col("s_suppkey"))
    )
    failed = F.col("l_returnflag") == "R"
    return lines.select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey")).alias("inspection_id"),
        _text("o_custkey").alias("project_id"),
        "site_name",
        "division",
        pick(F.col("l_linenumber"), ("weld_test", "concrete_test", "survey")).alias("inspection_type"),
        pick(F.col("l_partkey"), ("structural", "civil", "electrical")).alias("discipline"),
        F.when(failed, "fail").when(F.col("l_returnflag") == "A", "conditional").otherwise("pass").alias("result"),
        F.when(failed, pick(F.col("l_partkey"), ("crack", "void", "alignment", "finish"))).alias("defect_category"),
        F.when(failed, pick(F.col("l_suppkey"), ("Critical", "Serious", "Moderate", "Minor"))).alias("severity"),
        failed.alias("rework_required"),
        F.when(failed, (dec("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast("double")).alias("rework_cost_aud"),
        F.concat(F.lit("INSP-"), _text(F.col("l_suppkey") % 15)).alias("inspector"),
        F.to_date("l_shipdate").alias("inspection_date"),
    )


# --- operations -------------------------------------------------------------


def telemetry(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t["site_events"].select(
        F.concat(F.lit("EQ-"), _text("user_id")).alias("equipment_id"),
        pick(F.col("user_id"), EQUIPMENT_TYPES).alias("equipment_type"),
        pick(F.col("user_id"), MANUFACTURERS).alias("manufacturer"),
        "site_name",
        "division",
        (F.lit(70.0) + F.col("value") * 0.5).alias("engine_temp_celsius"),
        F.col("k").cast("double").alias("fuel_level_pct"),
        (F.lit(100.0) + F.col("k") * 3.5).alias("hydraulic_pressure_bar"),
        (F.lit(20.0) + F.col("value") * 0.1).alias("fuel_consumption_lph"),
        (F.lit(100.0) - F.col("k")).alias("utilisation_pct"),
        (F.col("user_id") * 131 % 20000).cast("int").alias("operating_hours"),
        F.date_add(F.to_date("ts"), F.col("k") - 50).alias("maintenance_due_date"),
        F.when(kind == "error", "critical")
        .when(kind == "signup", "warning")
        .when(kind == "purchase", "maintenance")
        .otherwise("operational")
        .alias("status"),
        F.col("ts").alias("reading_timestamp"),
    )


def incidents(t: Tables) -> DataFrame:
    k, minor = F.col("k"), F.col("k") >= 55
    kind = pick(F.col("event_id"), INCIDENT_TYPES)
    injuries = F.when(minor, F.lit(0)).otherwise(k % 4).cast("int")
    lost = F.when(minor, F.lit(0.0)).otherwise(F.floor(F.col("value") * 0.1).cast("double"))
    return t["site_events"].filter(F.col("event_type").isin("error", "signup")).select(
        F.concat(F.lit("INC-"), _text("event_id")).alias("incident_id"),
        F.date_add(F.to_date("ts"), (F.col("event_id") % 180).cast("int")).alias("incident_date"),
        "site_name",
        "division",
        kind.alias("incident_type"),
        label([(k < 7, "Critical"), (k < 25, "Serious"), (k < 55, "Moderate")], "Minor").alias("severity"),
        F.concat(kind, F.lit(" at "), F.col("site_name")).alias("description"),
        injuries.alias("injuries"),
        lost.alias("lost_time_days"),
        pick(F.col("event_id"), ROOT_CAUSES).alias("root_cause"),
        F.concat(F.lit("review "), pick(F.col("event_id"), ROOT_CAUSES)).alias("corrective_action"),
        pick(F.col("event_id"), ("open", "investigating", "closed")).alias("status"),
        pick(F.col("event_id"), ("day", "night")).alias("shift"),
        ((injuries == 0) & (lost == 0.0)).alias("is_near_miss"),
    )


def maintenance_log(t: Tables) -> DataFrame:
    value = dec("value")
    part = lambda text: (value * F.lit(text).cast("decimal(4,1)")).cast("double")
    return t["site_events"].filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("WO-"), _text("event_id")).alias("work_order_id"),
        F.concat(F.lit("EQ-"), _text("user_id")).alias("equipment_id"),
        pick(F.col("event_id"), ("scheduled", "unscheduled", "breakdown", "inspection")).alias("maintenance_type"),
        F.concat(F.lit("work order "), _text("event_id")).alias("description"),
        (F.col("k") * 0.5).alias("downtime_hours"),
        part("100.0").alias("cost_aud"),
        part("60.0").alias("parts_cost_aud"),
        part("40.0").alias("labour_cost_aud"),
        label([(F.col("k") < 20, "high"), (F.col("k") < 60, "medium")], "low").alias("priority"),
        label([(F.col("k") < 90, "completed")], "open").alias("status"),
        "site_name",
        "division",
        F.to_date("ts").alias("work_date"),
    )


def timesheets(t: Tables) -> DataFrame:
    d = lambda text: F.lit(text).cast("decimal(4,2)")
    extra = F.when(F.col("k") >= 80, F.col("k") - 80).otherwise(0).cast("decimal(4,0)") * d("0.25")
    wage = (F.lit(40) + F.col("user_id") % 30).cast("decimal(4,0)")
    cost = d("7.60") * wage + extra * wage * d("1.50")
    odd = F.when(F.col("event_id") % 50 == 0, F.lit(10)).otherwise(F.lit(0)).cast("decimal(4,0)")
    return t["site_events"].filter(F.col("event_type").isin("view", "click")).select(
        F.concat(F.lit("TS-"), _text("event_id")).alias("timesheet_id"),
        F.concat(F.lit("E-"), _text("user_id")).alias("employee_id"),
        _text("user_id").alias("project_id"),
        pick(F.col("user_id"), ROLES).alias("role"),
        "site_name",
        "division",
        F.lit(7.6).alias("hours_regular"),
        extra.cast("double").alias("hours_overtime"),
        wage.cast("double").alias("hourly_rate_aud"),
        (cost + odd).cast("double").alias("total_cost_aud"),
        pick(F.col("event_id"), ("none", "none", "none", "annual", "sick")).alias("leave_type"),
        (F.col("k") % 10 != 0).alias("is_inducted"),
        F.to_date("ts").alias("work_date"),
    )


def emissions(t: Tables) -> DataFrame:
    hour = F.lpad(_text(F.col("event_id") % 24), 2, "0")
    return t["site_events"].select(
        F.concat(F.lit("R-"), _text("event_id")).alias("reading_id"),
        "site_name",
        "division",
        pick(F.col("event_id"), MONITORS).alias("monitor_type"),
        pick(F.col("event_id"), MONITOR_UNITS).alias("unit"),
        F.col("value").alias("measurement_value"),
        F.lit(100.0).alias("threshold_value"),
        (F.col("value") > 100.0).alias("is_exceedance"),
        pick(F.col("user_id"), ("N", "E", "S", "W")).alias("wind_direction"),
        pick(F.col("k"), ("none", "water_cart", "stop_work")).alias("action_taken"),
        F.to_date("ts").alias("reading_date"),
        F.concat(hour, F.lit(":00")).alias("reading_time"),
    )


def materials(t: Tables) -> DataFrame:
    """Newest line of each (part, supplier)."""
    newest = dedup_latest(
        t["lineitem"].select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"),
        ["l_partkey", "l_suppkey"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )
    rows = newest.join(
        t["part"].select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey")
    ).join(t["supplier_sites"], F.col("l_suppkey") == F.col("s_suppkey"))
    by4, by20 = F.col("l_partkey") % 4, F.col("l_partkey") % 20
    return rows.select(
        F.concat_ws("-", _text("l_partkey"), _text("l_suppkey")).alias("material_id"),
        F.col("p_name").alias("material_name"),
        F.col("p_type").alias("category"),
        F.col("s_name").alias("supplier"),
        F.col("p_retailprice").alias("unit_price_aud"),
        F.lit("unit").alias("unit"),
        F.col("p_size").alias("lead_time_days"),
        F.to_date("l_shipdate").alias("last_order_date"),
        F.col("l_quantity").alias("last_order_qty"),
        label([(by4 == 0, "increasing"), (by4 == 3, "decreasing")], "stable").alias("price_trend"),
        label([(by20 == 0, "out_of_stock"), (by20 < 4, "limited"), (by20 < 9, "moderate")], "good").alias("availability"),
        rules.est_spend("p_retailprice", "l_quantity").cast("double").alias("total_cost_aud"),
        "site_name",
        "division",
        F.col("l_orderkey").alias("_orderkey"),
    )


def project_materials(t: Tables) -> DataFrame:
    """Materials with the project that last ordered them."""
    owner = t["orders"].select("o_orderkey", _text("o_custkey").alias("project_id"))
    return dealt(t["materials"], "_orderkey").join(owner, F.col("_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def bill(t: Tables) -> DataFrame:
    """A bill of materials: everything with a lead time of three weeks, in its last quantity."""
    return t["materials"].filter(F.col("lead_time_days") == 21).select(
        "material_id", F.col("last_order_qty").cast("bigint").alias("qty")
    )


def market_prices(t: Tables) -> DataFrame:
    """Average retail price per category."""
    return t["part"].groupBy(F.col("p_type").alias("category")).agg(
        aggs.avg_rounded("p_retailprice", 2).alias("market_price_aud")
    )


# --- tables whose detail is not recorded elsewhere --------------------------


def manufacturing_kpis(t: Tables) -> DataFrame:
    lines = t["lineitem"].groupBy("l_suppkey", F.trunc("l_shipdate", "MM").alias("month")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_back"),
    )
    rows = lines.join(t["supplier_sites"].select("s_suppkey", "division"), F.col("l_suppkey") == F.col("s_suppkey"))
    return (
        rows.groupBy("month", "division")
        .agg(F.sum("qty").alias("qty"), F.sum("n_lines").alias("n_lines"), F.sum("n_back").alias("n_back"))
        .select(
            "month",
            "division",
            F.col("qty").alias("throughput_tonnes"),
            (F.lit(60.0) + F.col("n_lines") % 40).alias("utilisation_pct"),
            (F.col("n_back") * 0.5).alias("downtime_hours"),
            (F.col("qty") * 2.5).alias("energy_kwh"),
            F.col("n_back").alias("waste_tonnes"),
        )
    )


def supplier_contracts(t: Tables) -> DataFrame:
    """Contract attributes of a supplier (given, not derivable from deliveries)."""
    by5 = F.col("s_suppkey") % 5
    return t["supplier_sites"].select(
        F.col("s_name").alias("supplier_name"),
        "division",
        label([(by5 == 0, "Expiring Soon"), (by5 == 1, "Under Review")], "Active").alias("contract_status"),
    )


def supplier_lines(t: Tables) -> DataFrame:
    """Order lines as an executive scorecard needs them: on time, rejected, value."""
    lines = (
        t["lineitem"]
        .join(t["orders"].select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return lines.select(
        F.col("s_name").alias("supplier_name"),
        F.col("p_type").alias("category"),
        F.col("l_extendedprice").alias("amount_aud"),
        (F.to_date("l_shipdate") <= F.date_add(F.to_date("o_orderdate"), 45)).alias("on_time"),
        (F.col("l_returnflag") == "R").alias("rejected"),
        F.to_date("l_shipdate").alias("day"),
    )


VIEWS = {
    "sites": sites,
    "site_lookup": site_lookup,
    "site_events": site_events,
    "supplier_sites": supplier_sites,
    "customer_sites": customer_sites,
    "bronze_gps_pings": gps_pings,
    "bronze_delivery_receipts": delivery_receipts,
    "bronze_supplier_invoices": supplier_invoices,
    "bronze_warehouse_stock": warehouse_stock,
    "order_values": order_values,
    "financials": financials,
    "milestones": milestones,
    "inspections": inspections,
    "telemetry": telemetry,
    "incidents": incidents,
    "maintenance_log": maintenance_log,
    "timesheets": timesheets,
    "emissions": emissions,
    "materials": materials,
    "project_materials": project_materials,
    "bill": bill,
    "market_prices": market_prices,
    "manufacturing_kpis": manufacturing_kpis,
    "supplier_contracts": supplier_contracts,
    "supplier_lines": supplier_lines,
}


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a path's schema is read from its footers once per application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def derived_tables(spark: SparkSession, folder: str) -> Tables:
    """Registry over the parquet files in ``folder`` with every derived view on top."""
    from quarrylens.plans import products

    base = {name: (lambda t, p=f"{folder}/{name}.parquet": read_table(t.spark, p)) for name in BASE_TABLES}
    return Tables(spark, {**base, **VIEWS, **products.PRODUCTS})
