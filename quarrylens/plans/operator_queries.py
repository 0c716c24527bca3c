"""Registered forms of the operators that are not catalogue questions.

Every one reads the given tables: security over financials and incidents, streams over the
event file, retrieval over documents and embeddings, evaluation over labels.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.functions import aggs, rules
from quarrylens.functions.numeric import fmt_money, rnd
from quarrylens.functions.predicates import after_hour, month_start
from quarrylens.functions.vocab import canonicalise_vocab
from quarrylens.operators import evaluate, retrieval, security, windows
from quarrylens.operators.latest import dedup_latest
from quarrylens.operators.rights import RightsIndex
from quarrylens.plans import gold, pipeline, silver
from quarrylens.plans.rollups import MONEY
from quarrylens.session import shuffles_let_go, work_dir
from quarrylens.sources import copies, landing, sinks
from quarrylens.sources.derived import DELIVERY_ORDER, VIEWS, derived_tables
from quarrylens.sources.landing import BAD_COLUMNS, as_text, conform
from quarrylens.sources.schemas import DELIVERY_RECEIPTS, INCIDENTS, SUPPLIER_INVOICES, schema
from quarrylens.sources.tables import Tables
from quarrylens.streaming import jobs, products

DEMOS = {}
LOADED_AT = datetime(2001, 7, 1)
PACKED_LINES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}


def demo(key: str):
    def register(fn):
        DEMOS[key] = fn
        return fn

    return register


# --- governed access --------------------------------------------------------


def memberships(t: Tables) -> DataFrame:
    """Customers as principals: most belong to their region's group, some to executives, some to none."""
    key = F.col("c_custkey")
    group = F.when(key % 50 == 0, F.lit(security.EXECUTIVES)).when(key % 7 != 0, F.concat(F.lit("Group-"), F.col("division")))
    rows = t["customer_sites"].select(F.concat(F.lit("user-"), key.cast("string")).alias("principal"), group.alias("group_name"))
    return rows.filter(F.col("group_name").isNotNull())


def group_mapping(t: Tables) -> DataFrame:
    return t["region"].select(F.concat(F.lit("Group-"), F.col("r_name")).alias("group_name"), F.col("r_name").alias("division"))


POLICY = security.Policy({"Group-ASIA": "ASIA", "Group-EUROPE": "EUROPE"}, masked=("budget_aud",))


@demo("k1_division_filter")
def division_filter(t: Tables) -> DataFrame:
    """Financials as two groups see them, budgets masked."""
    return security.secure(t["financials"], ["Group-ASIA", "Group-EUROPE"], POLICY).select(
        "project_id", "division", "reporting_period", "budget_aud"
    )


@demo("k2_executive_view")
def executive_view(t: Tables) -> DataFrame:
    return security.secure(t["financials"], [security.EXECUTIVES], POLICY).groupBy("division").agg(
        aggs.n_rows().alias("row_count"), aggs.total("budget_aud", MONEY).alias("budget_aud")
    )


@demo("k2_no_group")
def no_group(t: Tables) -> DataFrame:
    """A caller in no group sees nothing; the count still comes back."""
    return security.secure(t["incidents"], ["Group-NOWHERE"], security.Policy({})).agg(aggs.n_rows().alias("row_count"))


@demo("k3_mask_budget")
def mask(t: Tables) -> DataFrame:
    return t["financials"].select("project_id", "reporting_period", security.mask_budget("budget_aud", False, 1e5).alias("masked_budget"))


@demo("k4_membership_semi_join")
def membership_semi_join(t: Tables) -> DataFrame:
    return security.secure_by_membership(t["telemetry"], "user-1", memberships(t), group_mapping(t)).groupBy("division", "status").agg(
        aggs.n_rows().alias("row_count")
    )


@demo("k5_role_policy")
def role_policy(t: Tables) -> DataFrame:
    division = F.col("division")
    roles = [
        security.Role("AsiaSafety", "Group-ASIA", "incidents", division == "ASIA"),
        security.Role("EuropeSafety", "Group-EUROPE", "incidents", division == "EUROPE"),
        security.Role("AsiaFinance", "Group-ASIA", "financials", division == "ASIA"),
    ]
    mine = ["Group-EUROPE"]
    return sinks.audit_counts(
        {
            "incidents": security.apply_roles(t["incidents"], "incidents", roles, mine),
            "financials": security.apply_roles(t["financials"], "financials", roles, mine),
        }
    )


@demo("k7_verify_visibility")
def visibility(t: Tables) -> DataFrame:
    return security.verify_visibility(
        {"financials": t["financials"], "incidents": t["incidents"], "telemetry": t["telemetry"]}, memberships(t), group_mapping(t)
    )


@demo("k7_membership_flags")
def flags(t: Tables) -> DataFrame:
    return security.membership_flags(memberships(t), ["Group-ASIA", security.EXECUTIVES])


# --- sources and operators --------------------------------------------------


@demo("a5_conform_rejects")
def conform_rejects(t: Tables) -> DataFrame:
    """Invoices as text, some amounts unreadable, conformed to the declared schema."""
    raw = t["bronze_supplier_invoices"].drop("line_items")
    text = raw.select(*[F.col(f.name).cast("string").alias(f.name) for f in as_text(SUPPLIER_INVOICES) if f.name in raw.columns])
    spoiled = text.withColumn("gst_aud", F.when(F.col("po_number").cast("bigint") % 10 == 0, F.lit("n/a")).otherwise(F.col("gst_aud")))
    out = conform(spoiled, SUPPLIER_INVOICES, report=True)
    return out.groupBy(F.array_join(BAD_COLUMNS, ",").alias("bad_columns"), F.col("line_items").isNull().alias("line_items_missing")).agg(
        aggs.n_rows().alias("row_count"), aggs.total("gst_aud", 3).alias("gst_aud")
    )


@demo("b12_audit_counts")
def audit(t: Tables) -> DataFrame:
    names = ["silver_fleet_positions", "silver_deliveries", "silver_inventory", "silver_invoices"]
    return sinks.audit_counts({n: t[n] for n in names})


@demo("l2_category_basis")
def category_basis(t: Tables) -> DataFrame:
    """Cost check against the material's average price."""
    rows = silver.deliveries(t["bronze_delivery_receipts"], DELIVERY_ORDER, basis="category")
    return rows.groupBy("material", "cost_validated").agg(aggs.n_rows().alias("deliveries"))


@demo("l3_other_labels")
def other_labels(t: Tables) -> DataFrame:
    from quarrylens.plans.products import ORDERS_AS_OF

    rows = silver.inventory_snapshots(t["bronze_warehouse_stock"], ORDERS_AS_OF, ("_ingested_at",), labels=("critical", "low", "adequate", "surplus"))
    return rows.groupBy("region", "stock_status").agg(aggs.n_rows().alias("items"))


@demo("l10_other_tiers")
def other_tiers(t: Tables) -> DataFrame:
    card = gold.supplier_scorecard(t["silver_deliveries"], t["silver_invoices"], tiers=("Gold", "Silver", "Bronze", "At Risk"))
    return card.select("supplier", "supplier_score", "supplier_tier")


@demo("l11_bronze_twice")
def bronze_twice(t: Tables) -> DataFrame:
    """Loading a batch twice leaves the clean layer as it was: compared row by row."""
    once = silver.deliveries(t["bronze_delivery_receipts"], DELIVERY_ORDER)
    twice = silver.deliveries(t["bronze_delivery_receipts"].unionAll(t["bronze_delivery_receipts"]), DELIVERY_ORDER)
    return evaluate.execution_match(twice, once)


@demo("t6_canonical_vocab")
def canonical_vocab(t: Tables) -> DataFrame:
    """Other spellings written into the incident severities, mapped back, counted."""
    other = F.when(F.col("severity") == "Serious", F.lit(" MAJOR")).when(F.col("severity") == "Minor", F.lit("low")).otherwise(F.col("severity"))
    return canonicalise_vocab(t["incidents"].withColumn("severity", other), {"severity": "severity"}).groupBy("severity").agg(
        aggs.n_rows().alias("incidents")
    )


@demo("e_rollup_totals")
def rollup_totals(t: Tables) -> DataFrame:
    return t["incidents"].rollup("division", "site_name").agg(aggs.n_rows().alias("incidents"), aggs.total("lost_time_days").alias("lost_days"))


@demo("e4_basic_measures")
def basic_measures(t: Tables) -> DataFrame:
    return t["telemetry"].groupBy("equipment_type").agg(*aggs.basic("engine_temp_celsius", "temp", 3))


@demo("f6_rank_with_gaps")
def rank_with_gaps(t: Tables) -> DataFrame:
    """Global rank of all units by hours, without a single-task window."""
    units = t["telemetry"].groupBy("equipment_id").agg(F.max("fuel_level_pct").alias("top_fuel"))
    return windows.ranked(units, "top_fuel", out="fuel_rank", dense=False)


@demo("f7_month_to_date")
def month_to_date(t: Tables) -> DataFrame:
    daily = t["incidents"].withColumn("n", F.lit(1).cast("bigint"))
    return windows.month_to_date(daily, "incident_date", "n", ["division"])


@demo("c13_after_hour")
def evening(t: Tables) -> DataFrame:
    return t["emissions"].filter(after_hour("reading_time", "18:00")).groupBy("reading_time").agg(aggs.n_rows().alias("readings"))


@demo("r_evm")
def evm(t: Tables) -> DataFrame:
    """Rule operators side by side over all financial rows."""
    ev, ac, pv, bac = "earned_value_aud", "actual_cost_aud", "planned_value_aud", "budget_aud"
    return t["financials"].select(
        "project_id",
        "reporting_period",
        rnd(rules.cv(ev, ac), 2).alias("cv"),
        rnd(rules.sv(ev, pv), 2).alias("sv"),
        rules.rag("cost_variance_pct", "spi", "cpi").alias("rag_controls"),
        rules.rag("cost_variance_pct", "spi", "cpi", "governance").alias("rag_governance"),
        rules.risk_class("cpi", "spi").alias("risk_class"),
        rules.high_risk("status", "cpi").alias("high_risk"),
        rules.index_alert("cpi", "spi").alias("index_alert"),
        rules.approver(rules.vac(bac, "cpi") * -1.0).alias("approver"),
        rules.evm_required(bac).alias("evm_required"),
    )


@demo("r_suppliers")
def supplier_flags(t: Tables) -> DataFrame:
    return t["exec_scorecard"].select(
        "supplier_name",
        "category",
        rules.poor_quality("quality_score").alias("poor_quality"),
        rules.unreliable("on_time_delivery_pct").alias("unreliable"),
        rules.critical_supplier("total_spend_aud", "quality_score").alias("critical_supplier"),
        rules.contract_expiring("contract_status").alias("contract_expiring"),
    )


@demo("r_safety")
def safety_flags(t: Tables) -> DataFrame:
    return t["incidents"].groupBy(
        rules.is_lti("lost_time_days").alias("is_lti"),
        rules.is_near_miss("injuries", "incident_type").alias("is_near_miss"),
        rules.is_significant("severity").alias("is_significant"),
        rules.is_open("status").alias("is_open"),
        rules.systemic_cause("root_cause").alias("is_systemic"),
    ).agg(aggs.n_rows().alias("incidents"))


@demo("r_fmt_money")
def money(t: Tables) -> DataFrame:
    per = t["financials"].groupBy("division").agg(aggs.total("budget_aud", MONEY).alias("budget_aud"))
    return per.select("division", fmt_money("budget_aud").alias("budget"))


# --- streams ----------------------------------------------------------------

EVENT_SCHEMA = schema(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
DELAY = "1 day"


def stream_tables(spark: SparkSession, folder: str) -> Tables:
    """The derived tables with ``events`` read as a stream; the same view builders apply."""
    t = derived_tables(spark, folder)
    events = jobs.read_stream(spark, f"{folder}/events*.parquet", "parquet", EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    return t.with_tables(events=events, **{n: VIEWS[n] for n in ("site_events",)})


def _log(spark: SparkSession, df: DataFrame, label: str, mode: str = "update", shape=None) -> str:
    root = work_dir(spark, label)
    jobs.run_to_end(jobs.write_log(df, f"{root}/log", f"{root}/checkpoint", mode, shape))
    return f"{root}/log"


def _naive(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _positions(t: Tables) -> DataFrame:
    """Stateless part of the clean layer; duplicates are the business of the stream operators."""
    from quarrylens.functions.numeric import clamp
    from quarrylens.functions.predicates import in_bbox

    speed = F.col("speed_kmh")
    return (
        t["bronze_gps_pings"]
        .filter(in_bbox("latitude", "longitude", *silver.BBOX))
        .withColumn("speed_kmh", clamp(speed, *silver.SPEED_RANGE))
        .withColumns({"is_moving": speed > 1.0, "is_idling": F.col("engine_on") & (speed <= 1.0)})
    )


STREAMS = {}


def stream(key: str):
    def register(fn):
        STREAMS[key] = fn
        return fn

    return register


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """Input that a query takes up several times, computed once."""
    with shuffles_let_go(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _landing(spark: SparkSession, folder: str, label: str) -> tuple[Tables, str]:
    """Invoices written as landing files, one folder per batch."""
    t = derived_tables(spark, folder)
    root = work_dir(spark, label)
    names = [f.name for f in SUPPLIER_INVOICES if f.name != "batch_id"]
    feed = t["bronze_supplier_invoices"].select(*names, "batch_id", F.col("batch_id").alias("batch"))
    feed.write.partitionBy("batch").option("header", True).csv(f"{root}/landing")
    return t, root


@stream("j1_stream_ingest")
def j1(spark: SparkSession, folder: str) -> DataFrame:
    """Landing files taken up by two runs of the same stream, a few at a time: each counts once."""
    _, root = _landing(spark, folder, "ingest")
    for _ in range(2):
        jobs.run_to_end(
            jobs.stream_ingest(
                spark, f"{root}/landing", "*.csv", "csv", SUPPLIER_INVOICES, f"{root}/log", f"{root}/checkpoint", LOADED_AT, 4
            )
        )
    return jobs.read_log(spark, f"{root}/log").filter("_rejected = 0").groupBy("batch_id", "payment_status").agg(
        aggs.n_rows().alias("invoices"), aggs.total("total_aud", 3).alias("total_aud")
    )


@stream("j3_stream_upsert_latest")
def j3(spark: SparkSession, folder: str) -> DataFrame:
    """Newest invoice per purchase-order site and status, kept across micro-batches of a few files."""
    _, root = _landing(spark, folder, "upsert")
    source = jobs.read_stream(spark, f"{root}/landing/*/*.csv", "csv", SUPPLIER_INVOICES, files_per_trigger=4)
    keys, order = ["site", "payment_status"], ["invoice_date", F.col("invoice_id").cast("bigint")]
    query, table = jobs.stream_upsert_latest(source, f"{root}/table", keys, order, f"{root}/checkpoint", buckets=2)
    jobs.run_to_end(query)
    return table.read().select(*keys, "invoice_id", "invoice_date", "total_aud")


@stream("j2_stream_dedup")
def j2(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream joined with itself once more (every ping twice), deduplicated within the watermark."""
    t = stream_tables(spark, folder)
    pings = t["bronze_gps_pings"].select("ping_id", "vehicle_id", "ping_timestamp")
    doubled = pings.unionAll(pings)
    path = _log(spark, jobs.stream_dedup(doubled, ["ping_id"], "ping_timestamp", DELAY), "dedup", "append")
    return _naive(jobs.read_log(spark, path).drop("_batch"), "ping_timestamp")


@stream("j4_stream_fleet_daily")
def j4(spark: SparkSession, folder: str) -> DataFrame:
    daily = jobs.stream_fleet_daily(_positions(stream_tables(spark, folder)), DELAY)
    path = _log(spark, daily, "fleet")
    return jobs.read_latest(spark, path, ["report_date", "vehicle_id", "vehicle_type", "site_name"])


@stream("j5_stream_alerts")
def j5(spark: SparkSession, folder: str) -> DataFrame:
    alerts = jobs.stream_alerts(stream_tables(spark, folder)["telemetry"], DELAY)
    path = _log(spark, alerts, "alerts")
    return _naive(jobs.read_latest(spark, path, ["window_start", "equipment_id"]), "window_start", "window_end")


@stream("j6_stream_idle_sessions")
def j6(spark: SparkSession, folder: str) -> DataFrame:
    """Closed idle sessions: those the watermark has passed; the open ones stay in the state."""
    sessions = jobs.stream_idle_sessions(_positions(stream_tables(spark, folder)), DELAY, "6 hours")
    return _naive(jobs.read_log(spark, _log(spark, sessions, "idle", "append")).drop("_batch"), "idle_from", "idle_to")


@stream("j7_stream_latest")
def j7(spark: SparkSession, folder: str) -> DataFrame:
    """Newest reading per unit over four micro-batches in no order of time, the last of them after a restart."""
    readings = derived_tables(spark, folder)["telemetry"].select(
        "equipment_id", "site_name", "status", "engine_temp_celsius", F.col("reading_timestamp").cast("timestamp")
    )
    root = work_dir(spark, "latest")
    batch = F.pmod(F.xxhash64("equipment_id", "reading_timestamp", "engine_temp_celsius"), F.lit(4))
    order = ["reading_timestamp", "status", "engine_temp_celsius"]
    for chosen in (batch < 3, batch == 3):
        readings.where(chosen).withColumn("batch", batch).repartition(4, "batch").drop("batch").write.mode("append").parquet(f"{root}/readings")
        source = jobs.read_stream(spark, f"{root}/readings", "parquet", readings.schema, files_per_trigger=1)
        query, table = jobs.stream_latest(source, f"{root}/table", ["equipment_id"], order, f"{root}/checkpoint", buckets=2)
        jobs.run_to_end(query)
    return _naive(table.read(), "reading_timestamp")


@stream("j8_stream_refresh_mv")
def j8(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries streamed over several micro-batches: every row twice, every seventh first in a wrong form."""
    t = derived_tables(spark, folder)
    root = work_dir(spark, "mv")
    rows = _stored(t["silver_deliveries"].select(products.ID, *products.COUNTED, F.lit(2).alias("version")), f"{root}/rows")
    wrong = rows.withColumns(
        {
            "version": F.lit(1),
            "total_cost": F.col("total_cost") * 2 + 1,
            "material": F.lit("unknown"),
            "is_damaged": ~F.col("is_damaged"),
            "destination_site": F.when(F.length(products.ID) % 2 == 0, F.lit("elsewhere")).otherwise(F.col("destination_site")),
        }
    )
    seventh = F.pmod(F.xxhash64(products.ID), F.lit(7)) == 0
    first = rows.where(~seventh).unionByName(wrong.where(seventh))
    product = products.DeliveryPerformance(spark, f"{root}/product", rows.schema, ["version"], buckets=2)
    # The corrections, then both once more: repeated rows and outdated ones change nothing.
    for part in (first, rows.where(seventh), first.unionByName(rows.where(seventh))):
        part.write.mode("append").option("compression", "zstd").parquet(f"{root}/clean")
        source = jobs.read_stream(spark, f"{root}/clean", "parquet", rows.schema, files_per_trigger=16)
        jobs.run_to_end(product.refresh(source, f"{root}/checkpoint"))
    return product.read()


@stream("j9_stream_enrich")
def j9(spark: SparkSession, folder: str) -> DataFrame:
    """Readings joined to the site dimension inside the stream, counted per division and day."""
    t = stream_tables(spark, folder)
    raw = t["events"].withColumn("site_key", (F.col("user_id") % 25).cast("int"))
    static = t["sites"].withColumnRenamed("n_nationkey", "site_key")
    joined = jobs.stream_enrich(raw, static, "site_key").withWatermark("ts", DELAY)
    daily = joined.groupBy(F.window("ts", "1 day").alias("_d"), "division").agg(aggs.n_rows().alias("readings")).select(
        F.to_date("_d.start").alias("day"), "division", "readings"
    )
    return jobs.read_latest(spark, _log(spark, daily, "enrich"), ["day", "division"])


# --- retrieval and evaluation -----------------------------------------------


def keyword_queries(t: Tables) -> DataFrame:
    """Keywords of each benchmark item: all its distinct words; common ones weigh little in BM25."""
    words = t["benchmark"].select(F.col("item_id").alias("query_id"), F.explode(retrieval.tokens("text")).alias("term"))
    return words.distinct()


@demo("s1_chunks")
def chunks(t: Tables) -> DataFrame:
    return retrieval.chunk(t["documents"]).select("doc_id", "chunk_no", "start", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@demo("s1_sections")
def headed(t: Tables) -> DataFrame:
    """Sections of conversations at every user turn written as one headed text per turn."""
    turns = t["conversations"].select("conv_id", F.concat_ws("\n", F.lit("# head"), F.col("text"), F.lit("## tail"), F.col("role")).alias("text"))
    return retrieval.sections(turns, id_col="conv_id").groupBy("conv_id", "section").agg(
        aggs.n_rows().alias("parts"), aggs.total_int(F.length("text")).alias("n_chars")
    )


def _documents(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", "text")


@demo("s2_keyword_topk")
def keyword(t: Tables) -> DataFrame:
    return retrieval.keyword_topk(retrieval.chunk(_documents(t)), keyword_queries(t), 5, ["doc_id", "chunk_no"])


@demo("s3_nearest_in_group")
def nearest(t: Tables) -> DataFrame:
    return retrieval.nearest_in_group(t["embeddings"], retrieval.centres_of(t["embeddings"], "label"), "label", 5)


@demo("s3_vector_topk")
def vectors(t: Tables) -> DataFrame:
    centres = retrieval.centres_of(t["embeddings"], "label").withColumnRenamed("label", "query_id")
    return retrieval.vector_topk(t["embeddings"], centres, 5)


@demo("s3_vector_index")
def many_vectors(t: Tables) -> DataFrame:
    """Every fiftieth vector as a query against all vectors."""
    queries = t["embeddings"].where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("centre"))
    return retrieval.vector_topk(t["embeddings"], queries, 10)


@demo("s3_hybrid_topk")
def hybrid(t: Tables) -> DataFrame:
    """Benchmark item n beside label n: keyword hits on documents fused with vector hits of the same number."""
    words = retrieval.keyword_topk(_documents(t), keyword_queries(t), 20, ["doc_id"])
    centres = retrieval.centres_of(t["embeddings"], "label").select(F.col("label").cast("bigint").alias("query_id"), "centre")
    near = retrieval.vector_topk(t["embeddings"], centres, 20).withColumnRenamed("vec_id", "doc_id")
    return retrieval.fuse_ranks(words, near, 10, ["doc_id"]).drop("score")


def document_grants(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Sources per group, and groups per customer."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    acl = t["documents"].select("source", F.concat(F.lit("Group-"), (number % 3).cast("string")).alias("group_name")).distinct()
    grants = t["customer"].select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("principal"),
        F.concat(F.lit("Group-"), (F.col("c_custkey") % 5).cast("string")).alias("group_name"),
    )
    return acl, grants


@demo("s4_filtered_search")
def filtered(t: Tables) -> DataFrame:
    """Only sources granted to the caller's groups, only two languages."""
    acl, grants = document_grants(t)
    rights = RightsIndex.build(t["documents"])
    chosen = F.col("lang").isin("en", "fr")
    return retrieval.search(t["documents"], keyword_queries(t), 3, chosen, acl, grants, "user-1", "source", rights)


@demo("s4_visible_documents")
def visible_documents(t: Tables) -> DataFrame:
    """Documents each principal may search."""
    acl, grants = document_grants(t)
    return RightsIndex.build(t["documents"]).counts(grants, acl)


@demo("k4_rights_bitmaps")
def rights_bitmaps(t: Tables) -> DataFrame:
    """Incidents per principal under the division rule; executives are granted every division."""
    mapping = group_mapping(t)
    acl = mapping.unionByName(mapping.select(F.lit(security.EXECUTIVES).alias("group_name"), "division"))
    numbered = t["incidents"].select("division", F.substring("incident_id", 5, 20).cast("bigint").alias("number"))
    return RightsIndex.build(numbered, "division", "number").counts(memberships(t), acl)


@demo("s5_execution_match")
def match(t: Tables) -> DataFrame:
    """Monthly incident counts from detail against the KPI table, as multisets."""
    detail = t["incidents"].groupBy("division", month_start("incident_date").alias("month")).agg(aggs.n_rows().alias("total_incidents"))
    return evaluate.execution_match(detail, t["safety_kpis"].select("division", "month", "total_incidents"))


@demo("s6_eval_rollup")
def evaluation(t: Tables) -> DataFrame:
    """Document labels as three evaluators, one of them with scores; document sources as runs."""
    judged = t["labels"].join(t["documents"].select("doc_id", "source"), "doc_id")
    both = F.explode(
        F.array(
            F.struct(
                F.lit("coherence").alias("evaluator"),
                (F.col("quality") == 1).alias("passed"),
                F.when(F.col("quality") == 1, 5.0).otherwise(2.0).alias("score"),
            ),
            *[
                F.struct(F.lit(name).alias("evaluator"), (F.col("toxic") == 0).alias("passed"), F.lit(None).cast("double").alias("score"))
                for name in ("task_adherence", "violence")
            ],
        )
    )
    scores = judged.select(F.col("source").alias("run_id"), both.alias("e")).select("run_id", "e.*")
    return evaluate.eval_rollup(scores)


def newest_pings(t: Tables) -> DataFrame:
    return dedup_latest(t["bronze_gps_pings"], ["vehicle_id"], ["ping_timestamp", "ping_id"])


DEMOS["f1_newest_ping"] = lambda t: newest_pings(t).select("vehicle_id", "ping_id", "site_name")


@demo("i_round_large")
def round_large(t: Tables) -> DataFrame:
    """Rounding of amounts far beyond 2^53 beside ordinary ones."""
    price = F.col("l_extendedprice")
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        rnd(price * 1e12, 4).alias("large"),
        rnd(-price * 1e9, 4).alias("negative"),
        rnd(price / 7, 2).alias("ordinary"),
    )


@demo("e_fine_decimals")
def fine_decimals(t: Tables) -> DataFrame:
    """Sums and means of values with more than two decimals, and of very large ones."""
    fine, large = F.col("l_tax") / 16, F.col("l_extendedprice") * 1e9
    return t["lineitem"].groupBy("l_returnflag").agg(
        aggs.total(fine).alias("fine_sum"), aggs.mean(fine).alias("fine_mean"), aggs.mean(large).alias("large_mean")
    )


@demo("f3_null_group")
def null_group_share(t: Tables) -> DataFrame:
    """Severity shares where one division's rows have no division."""
    division = F.when(F.col("division") != "ASIA", F.col("division")).alias("division")
    counted = t["incidents"].groupBy(division, "severity").agg(aggs.n_rows().alias("incidents"))
    return windows.share_of_group(counted, ["division"], "incidents", "share_pct")


@demo("f6_null_rank")
def null_rank(t: Tables) -> DataFrame:
    """Rank of units by top fuel level, where some have no level."""
    level = F.when(F.col("equipment_id").rlike("[1-9]$"), F.max("fuel_level_pct")).alias("top_fuel")
    return windows.ranked(t["telemetry"].groupBy("equipment_id").agg(level), "top_fuel", out="fuel_rank", dense=False)


@stream("a_landing_roundtrip")
def landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices landed with columns moved, missing and added per file, loaded twice, read back by name."""
    t = derived_tables(spark, folder)
    root = work_dir(spark, "roundtrip")
    names = [f.name for f in SUPPLIER_INVOICES]
    rows = t["bronze_supplier_invoices"].select(*names)
    odd = F.year("invoice_date") % 2 == 1
    shuffled = rows.filter(odd).select(*reversed(names), F.lit("x").alias("remark")).drop("currency")
    rows.filter(~odd).write.option("header", True).csv(f"{root}/landing/20010701/supplier_invoices/a")
    shuffled.write.option("header", True).csv(f"{root}/landing/20010701/supplier_invoices/b")
    path, db = landing.resolve_batch(spark, f"{root}/landing"), f"roundtrip_{uuid.uuid4().hex}"
    sinks.ensure_db(spark, db)
    for _ in range(2):
        pipeline.land_feed(spark, path, "supplier_invoices", SUPPLIER_INVOICES, "csv", db, LOADED_AT)
    columns = ["invoice_id", "supplier", "currency", "site", "total_aud", "batch_id"]
    good, bad = spark.table(f"{db}.supplier_invoices"), spark.table(f"{db}.supplier_invoices_rejects")
    return good.select(columns).unionByName(bad.select(columns))


# --- tables, feeds and exports, written and read back -----------------------


def _scratch_db(spark: SparkSession) -> str:
    db = f"roundtrip_{uuid.uuid4().hex}"
    sinks.ensure_db(spark, db, "written and read back")
    return db


@stream("a3_json_feed")
def json_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts landed as JSON lines, loaded twice, by supplier."""
    t = derived_tables(spark, folder)
    root, db = work_dir(spark, "json"), _scratch_db(spark)
    names = [f.name for f in DELIVERY_RECEIPTS if f.name in t["bronze_delivery_receipts"].columns]
    # Lines of JSON repeat every name: packed they take a fraction, in files that a task each can read in a stream.
    packed = t["bronze_delivery_receipts"].select(*names).write.options(**PACKED_LINES)
    with shuffles_let_go(spark):
        packed.json(f"{root}/landing/20010701/delivery_receipts")
    path = landing.resolve_batch(spark, f"{root}/landing")
    for _ in range(2):
        pipeline.land_feed(spark, path, "delivery_receipts", DELIVERY_RECEIPTS, "json", db, LOADED_AT)
    return spark.table(f"{db}.delivery_receipts").groupBy("supplier").agg(aggs.n_rows().alias("receipts"), aggs.total_int("quantity").alias("quantity"))


@stream("b_table_building")
def table_building(spark: SparkSession, folder: str) -> DataFrame:
    """Declared table, appended to, rows replaced, copied, shown by a view; the first table then dropped."""
    rows = derived_tables(spark, folder)["incidents"].select(*INCIDENTS.names)
    db = _scratch_db(spark)
    sinks.ensure_table(spark, f"{db}.incidents", INCIDENTS, partition_by=["severity"], comment="incidents")
    for _ in range(2):
        sinks.append(rows.select(*spark.table(f"{db}.incidents").columns), f"{db}.incidents", partition_by=["severity"])
    twice = spark.table(f"{db}.incidents").count()
    sinks.overwrite_rows(rows, f"{db}.incidents")
    sinks.ctas(spark.table(f"{db}.incidents"), f"{db}.kept")
    sinks.mirror_copy(spark, f"{db}.kept", f"{db}.copied")
    sinks.define_view(spark, f"{db}.shown", f"SELECT division, severity, lost_time_days FROM {db}.copied", "copied incidents")
    sinks.drop_if_exists(spark, f"{db}.incidents")
    kinds = ",".join(sinks.table_kind(spark, f"{db}.{n}") for n in ("incidents", "copied", "shown"))
    return spark.table(f"{db}.shown").groupBy("division", "severity").agg(
        aggs.n_rows().alias("incidents"), aggs.total("lost_time_days").alias("lost_days")
    ).withColumns({"rows_after_two_appends": F.lit(twice).cast("bigint"), "kinds": F.lit(kinds)})


@stream("b6_refreshed_copy")
def refreshed_copy(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of the invoices in an older state, brought up to date by the ranges that differ."""
    rows = derived_tables(spark, folder)["silver_invoices"].select("invoice_id", "supplier", "payment_status", "total_aud")
    rows = _stored(rows, f"{work_dir(spark, 'invoices')}/rows")
    target = f"{_scratch_db(spark)}.invoices"
    number = F.pmod(F.xxhash64("invoice_id"), F.lit(97))
    older = rows.where(number != 5).withColumn("total_aud", F.when(number == 7, F.col("total_aud") + 1).otherwise(F.col("total_aud")))
    for state in (older, rows, rows):
        written = copies.refresh_copy(spark, state, target, ["invoice_id"], 32)
    return copies.copied(spark, target).withColumn("written_last", F.lit(len(written)))


@stream("b10_export")
def exported(spark: SparkSession, folder: str) -> DataFrame:
    """Division KPIs exported as CSV and JSON, read back and joined."""
    rows = derived_tables(spark, folder)["safety_kpis"].select("division", "month", "total_incidents")
    root = work_dir(spark, "export")
    sinks.export(rows, f"{root}/csv", "csv", files=1)
    sinks.export(rows, f"{root}/json", "json")
    csv = spark.read.schema(rows.schema).option("header", True).csv(f"{root}/csv")
    json = spark.read.schema(rows.schema).json(f"{root}/json").withColumnRenamed("total_incidents", "from_json")
    return csv.join(json, ["division", "month"])


@stream("b11_kpi_tables")
def kpi_tables(spark: SparkSession, folder: str) -> DataFrame:
    """KPI frames stored as tables and counted."""
    t, db = derived_tables(spark, folder), _scratch_db(spark)
    names = ("project_kpis", "safety_kpis", "fleet_kpis")
    for name in names:
        sinks.replace(t[name], f"{db}.{name}")
    return sinks.audit_counts({name: spark.table(f"{db}.{name}") for name in names})


@stream("k6_mirror_view")
def mirror_view(spark: SparkSession, folder: str) -> DataFrame:
    """The unfiltered view shows every division, whatever a filtered frame shows."""
    t = derived_tables(spark, folder)
    name = f"unfiltered_{uuid.uuid4().hex}"
    security.mirror_view(name, t["financials"])
    return spark.table(name).groupBy("division").agg(aggs.n_rows().alias("row_count"))


@demo("r23_type_of_prefix")
def type_of_prefix(t: Tables) -> DataFrame:
    """Units renumbered with the prefix of their type, and the type found again."""
    code = F.create_map(*[F.lit(x) for pair in rules.EQUIPMENT_PREFIXES.items() for x in reversed(pair)])
    prefix = F.coalesce(F.try_element_at(code, "equipment_type"), F.lit("XX"))
    named = t["telemetry"].select("equipment_type", F.concat_ws("-", F.lower(prefix), "equipment_id").alias("asset"))
    return named.groupBy("equipment_type", rules.equipment_type_of("asset").alias("found")).agg(aggs.n_rows().alias("readings"))
