"""SQL of the operator, security, streaming and retrieval queries."""

from __future__ import annotations

# Divisions each principal may see: (principal, division).
MEMBERS = """SELECT 'user-' || c_custkey AS principal,
       CASE WHEN c_custkey % 50 = 0 THEN 'Group-Executives' WHEN c_custkey % 7 <> 0 THEN 'Group-' || division END AS group_name
       FROM customer_sites"""
VISIBLE = f"""SELECT DISTINCT principal, r_name AS division FROM ({MEMBERS}) m
       JOIN region ON group_name = 'Group-Executives' OR group_name = 'Group-' || r_name"""

# Overlapping character windows of 800 with 100 shared.
CHUNKS = """SELECT doc_id, source, lang, CAST(start / 700 AS INT) AS chunk_no, CAST(start AS INT) AS start, substr(text, start + 1, 800) AS text
       FROM (SELECT *, unnest(range(0, greatest(length(text) - 101, 0) + 1, 700)) AS start FROM documents)"""


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 0)"


def keyword(source: str, key: str, k: int, extra: str = "") -> str:
    """BM25 top-k of the benchmark keywords over ``source``; returns query_id, key, score, rank."""
    return f"""
      kq AS (SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest({words('text')}) AS term FROM benchmark)),
      src AS (SELECT {key}, {words('text')} AS w FROM ({source}) {extra}),
      st AS (SELECT COUNT(*) AS n, RATIO(SUM(len(w)), COUNT(*)) AS avg_len FROM src),
      tf AS (SELECT {key}, term, COUNT(*) AS tf, MAX(dl) AS dl FROM (SELECT {key}, len(w) AS dl, unnest(w) AS term FROM src)
             WHERE term IN (SELECT term FROM kq) GROUP BY {key}, term),
      dfs AS (SELECT term, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf
              FROM (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1), st),
      part AS (SELECT {key}, term, CAST(idf * (DBL(tf) * 2.2::DOUBLE / (DBL(tf) + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_len))) AS DECIMAL(18,8)) AS p
               FROM tf JOIN dfs USING (term), st),
      scored AS (SELECT query_id, {key}, RND(DBL(SUM(p)), 4) AS score FROM part JOIN kq USING (term) GROUP BY query_id, {key}),
      kw AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS INT) AS rank FROM scored) WHERE rank <= {k})"""


CENTRES = """
      dims AS (SELECT label, pos, RATIO(SUM(CAST(x AS DECIMAL(18,9))), COUNT(*)) AS m
               FROM (SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings) GROUP BY 1, 2),
      centres AS (SELECT label, list(m ORDER BY pos) AS centre FROM dims GROUP BY 1)"""
COSINE = "RND(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6)"


def vector(k: int, same_label: bool = False) -> str:
    on = "e.label = c.label" if same_label else "true"
    return f"""{CENTRES},
      vec AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
              FROM (SELECT c.label AS query_id, vec_id, {COSINE} AS score FROM embeddings e JOIN centres c ON {on})) WHERE rank <= {k})"""


EVM_RAG = """CASE WHEN spi < {r} OR cpi < {r} OR cost_variance_pct < {rc} THEN 'red'
             WHEN spi {op} {g} OR cpi {op} {g} OR cost_variance_pct {op} {gc} THEN 'amber' ELSE 'green' END"""
MONEY = """CASE WHEN abs(b) >= 1e9 THEN '$' || format('{:,.1f}', b / 1e9) || 'B'
           WHEN abs(b) >= 1e6 THEN '$' || format('{:,.1f}', b / 1e6) || 'M' ELSE '$' || format('{:,.0f}', b) END"""

EXTRA: dict[str, str] = {
    # --- governed access
    "k1_division_filter": """SELECT project_id, division, reporting_period, RND(budget_aud / CAST(1e6 AS DOUBLE), 0) * CAST(1e6 AS DOUBLE) AS budget_aud
        FROM financials WHERE division IN ('ASIA', 'EUROPE')""",
    "k2_executive_view": "SELECT division, COUNT(*) AS row_count, TOT(budget_aud, 4) AS budget_aud FROM financials GROUP BY 1",
    "k2_no_group": "SELECT COUNT(*) AS row_count FROM incidents WHERE false",
    "k3_mask_budget": """SELECT project_id, reporting_period, RND(budget_aud / CAST(1e5 AS DOUBLE), 0) * CAST(1e5 AS DOUBLE) AS masked_budget FROM financials""",
    "k4_membership_semi_join": f"""SELECT division, status, COUNT(*) AS row_count FROM telemetry
        WHERE division IN (SELECT division FROM ({VISIBLE}) WHERE principal = 'user-1') GROUP BY 1, 2""",
    "k4_rights_bitmaps": f"""SELECT principal, SUM(n)::BIGINT AS documents FROM ({VISIBLE})
        JOIN (SELECT division, COUNT(DISTINCT incident_id) AS n FROM incidents GROUP BY 1) USING (division) GROUP BY 1""",
    "k5_role_policy": """SELECT 'incidents' AS table_name, CNT(division = 'EUROPE') AS row_count FROM incidents
        UNION ALL SELECT 'financials', 0""",
    "k7_verify_visibility": f"""SELECT principal, table_name, division, row_count FROM ({VISIBLE}) JOIN (
        SELECT 'financials' AS table_name, division, COUNT(*) AS row_count FROM financials GROUP BY 2
        UNION ALL SELECT 'incidents', division, COUNT(*) FROM incidents GROUP BY 2
        UNION ALL SELECT 'telemetry', division, COUNT(*) FROM telemetry GROUP BY 2) USING (division)""",
    "k7_membership_flags": f"""SELECT principal, bool_or(group_name = 'Group-ASIA') AS is_group_asia,
        bool_or(group_name = 'Group-Executives') AS is_group_executives FROM ({MEMBERS}) WHERE group_name IS NOT NULL GROUP BY 1""",
    # --- sources and operators
    "a5_conform_rejects": """SELECT CASE WHEN bad THEN 'gst_aud' ELSE '' END AS bad_columns, true AS line_items_missing, COUNT(*) AS row_count,
        TOT(CASE WHEN NOT bad THEN gst_aud END, 3) AS gst_aud FROM (SELECT *, CAST(po_number AS BIGINT) % 10 = 0 AS bad FROM silver_invoices) GROUP BY 1""",
    "b12_audit_counts": """SELECT 'silver_fleet_positions' AS table_name, COUNT(*) AS row_count FROM silver_fleet_positions
        UNION ALL SELECT 'silver_deliveries', COUNT(*) FROM silver_deliveries
        UNION ALL SELECT 'silver_inventory', COUNT(*) FROM silver_inventory
        UNION ALL SELECT 'silver_invoices', COUNT(*) FROM silver_invoices""",
    "l2_category_basis": """SELECT material, abs(unit_price - m) / m * 100 < 1.0 AS cost_validated, COUNT(*) AS deliveries
        FROM silver_deliveries JOIN (SELECT material, MEAN(unit_price, 4) AS m FROM silver_deliveries GROUP BY 1) USING (material) GROUP BY 1, 2""",
    "l3_other_labels": """SELECT region, CASE stock_status WHEN 'out_of_stock' THEN 'critical' WHEN 'below_reorder' THEN 'low' WHEN 'healthy' THEN 'adequate'
        ELSE 'surplus' END AS stock_status, COUNT(*) AS items FROM silver_inventory GROUP BY 1, 2""",
    "l10_other_tiers": """SELECT supplier, supplier_score, CASE supplier_tier[1] WHEN 'A' THEN 'Gold' WHEN 'B' THEN 'Silver' WHEN 'C' THEN 'Bronze'
        ELSE 'At Risk' END AS supplier_tier FROM gold_supplier_scorecard""",
    "l11_bronze_twice": "SELECT CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows, true AS is_match",
    "t6_canonical_vocab": "SELECT severity, COUNT(*) AS incidents FROM incidents GROUP BY 1",
    "e_rollup_totals": "SELECT division, site_name, COUNT(*) AS incidents, TOT(lost_time_days) AS lost_days FROM incidents GROUP BY ROLLUP (division, site_name)",
    "e4_basic_measures": """SELECT equipment_type, COUNT(*) AS temp_count, TOT(engine_temp_celsius, 3) AS temp_sum, MEAN(engine_temp_celsius, 3) AS temp_avg,
        MIN(engine_temp_celsius) AS temp_min, MAX(engine_temp_celsius) AS temp_max FROM telemetry GROUP BY 1""",
    "f6_rank_with_gaps": """SELECT *, rank() OVER (ORDER BY top_fuel DESC) AS fuel_rank
        FROM (SELECT equipment_id, MAX(fuel_level_pct) AS top_fuel FROM telemetry GROUP BY 1)""",
    "f7_month_to_date": """SELECT division, incident_date, n, CAST(SUM(n) OVER (PARTITION BY division, date_trunc('month', incident_date)
        ORDER BY incident_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS mtd
        FROM (SELECT division, incident_date, COUNT(*) AS n FROM incidents GROUP BY 1, 2)""",
    "c13_after_hour": "SELECT reading_time, COUNT(*) AS readings FROM emissions WHERE reading_time >= '18:00' GROUP BY 1",
    "f1_newest_ping": """SELECT vehicle_id, ping_id, site_name FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id
        ORDER BY ping_timestamp DESC, ping_id DESC) AS rn FROM bronze_gps_pings) WHERE rn = 1""",
    "r_evm": f"""SELECT project_id, reporting_period, RND(earned_value_aud - actual_cost_aud, 2) AS cv, RND(earned_value_aud - planned_value_aud, 2) AS sv,
        {EVM_RAG.format(r='0.95', rc='-5', g='1.0', gc='0', op='<')} AS rag_controls,
        {EVM_RAG.format(r='0.85', rc='-10', g='0.95', gc='-5', op='<=')} AS rag_governance,
        CASE WHEN least(cpi, spi) < 0.85 THEN 'Critical' WHEN least(cpi, spi) < 0.95 THEN 'High' WHEN least(cpi, spi) < 1 THEN 'Medium' ELSE 'Low' END AS risk_class,
        status = 'red' AND cpi < 0.9 AS high_risk, cpi < 0.9 OR spi < 0.85 AS index_alert,
        CASE WHEN v < 500000 THEN 'Project Manager' WHEN v < 2000000 THEN 'Senior Project Manager' WHEN v < 5000000 THEN 'Divisional Director'
             WHEN v <= 20000000 THEN 'Executive Committee' ELSE 'Board of Directors' END AS approver,
        budget_aud > 50000000 AS evm_required FROM (SELECT *, RATIO(budget_aud, cpi) - budget_aud AS v FROM financials)""",
    "r_suppliers": """SELECT supplier_name, category, quality_score < 3.0 AS poor_quality, on_time_delivery_pct < 85 AS unreliable,
        total_spend_aud > 1000000 AND quality_score < 3.0 AS critical_supplier, contract_status = 'Expiring Soon' AS contract_expiring FROM exec_scorecard""",
    "r_safety": """SELECT lost_time_days > 0 AS is_lti, injuries = 0 AND incident_type = 'Near Miss' AS is_near_miss,
        severity IN ('Critical', 'Serious') AS is_significant, status IN ('open', 'investigating') AS is_open,
        root_cause IN ('equipment_failure', 'inadequate_training') AS is_systemic, COUNT(*) AS incidents FROM incidents GROUP BY 1, 2, 3, 4, 5""",
    "r_fmt_money": f"SELECT division, {MONEY} AS budget FROM (SELECT division, TOT(budget_aud, 4) AS b FROM financials GROUP BY 1)",
    # Plain SQL, without the shared macros.
    "i_round_large": """SELECT l_orderkey, l_linenumber, l_extendedprice * 1e12::DOUBLE AS large,
        CASE WHEN l_extendedprice * 1e9::DOUBLE * 10000 >= 9007199254740992 THEN -l_extendedprice * 1e9::DOUBLE
             ELSE round(-l_extendedprice * 1e9::DOUBLE, 4) END AS negative,
        round(l_extendedprice / 7, 2) AS ordinary FROM lineitem""",
    "e_fine_decimals": """SELECT l_returnflag, CAST(SUM(CAST(l_tax / 16 AS DECIMAL(28,8))) AS DOUBLE) AS fine_sum,
        CAST(SUM(CAST(l_tax / 16 AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*) AS fine_mean,
        CAST(SUM(CAST(l_extendedprice * 1e9::DOUBLE AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*) AS large_mean FROM lineitem GROUP BY 1""",
    "f3_null_group": """SELECT division, severity, incidents, CAST(incidents AS DOUBLE) * 100.0::DOUBLE / CAST(SUM(incidents) OVER (PARTITION BY division) AS DOUBLE) AS share_pct
        FROM (SELECT CASE WHEN division <> 'ASIA' THEN division END AS division, severity, COUNT(*) AS incidents FROM incidents GROUP BY 1, 2)""",
    "f6_null_rank": """SELECT *, rank() OVER (ORDER BY top_fuel DESC NULLS LAST) AS fuel_rank
        FROM (SELECT equipment_id, CASE WHEN regexp_matches(equipment_id, '[1-9]$') THEN MAX(fuel_level_pct) END AS top_fuel FROM telemetry GROUP BY 1)""",
    # --- streams: the batch answer
    "a_landing_roundtrip": """SELECT invoice_id, supplier, CASE WHEN year(invoice_date) % 2 = 0 THEN 'AUD' END AS currency, site, total_aud,
        CAST(year(invoice_date) AS VARCHAR) AS batch_id FROM silver_invoices""",
    "a3_json_feed": "SELECT supplier, COUNT(*) AS receipts, CAST(SUM(quantity) AS BIGINT) AS quantity FROM bronze_delivery_receipts GROUP BY 1",
    "b_table_building": """SELECT division, severity, COUNT(*) AS incidents, TOT(lost_time_days) AS lost_days,
        (SELECT 2 * COUNT(*) FROM incidents) AS rows_after_two_appends, 'ABSENT,MANAGED,VIEW' AS kinds FROM incidents GROUP BY 1, 2""",
    "b6_refreshed_copy": "SELECT invoice_id, supplier, payment_status, total_aud, CAST(0 AS INT) AS written_last FROM silver_invoices",
    "b10_export": "SELECT division, month, total_incidents, total_incidents AS from_json FROM safety_kpis WHERE division IS NOT NULL",
    "b11_kpi_tables": """SELECT 'project_kpis' AS table_name, COUNT(*) AS row_count FROM project_kpis
        UNION ALL SELECT 'safety_kpis', COUNT(*) FROM safety_kpis UNION ALL SELECT 'fleet_kpis', COUNT(*) FROM fleet_kpis""",
    "k6_mirror_view": "SELECT division, COUNT(*) AS row_count FROM financials GROUP BY 1",
    "r23_type_of_prefix": """SELECT equipment_type, CASE WHEN equipment_type IN ('haul_truck', 'excavator', 'drill', 'loader', 'dozer', 'grader', 'water_cart', 'crane')
        THEN equipment_type END AS found, COUNT(*) AS readings FROM telemetry GROUP BY 1""",
    "j1_stream_ingest": """SELECT CAST(year(invoice_date) AS VARCHAR) AS batch_id, payment_status, COUNT(*) AS invoices, TOT(total_aud, 3) AS total_aud
        FROM silver_invoices GROUP BY 1, 2""",
    "j3_stream_upsert_latest": """SELECT site, payment_status, invoice_id, CAST(invoice_date AS VARCHAR) AS invoice_date, total_aud
        FROM (SELECT *, row_number() OVER (PARTITION BY site, payment_status ORDER BY invoice_date DESC, CAST(invoice_id AS BIGINT) DESC) AS rn
              FROM silver_invoices) WHERE rn = 1""",
    "j2_stream_dedup": "SELECT ping_id, vehicle_id, ping_timestamp FROM bronze_gps_pings",
    "j4_stream_fleet_daily": "SELECT * FROM gold_fleet_utilisation_daily",
    "j5_stream_alerts": """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, equipment_id, COUNT(*) AS readings,
        MAX(engine_temp_celsius) AS max_temp, MIN(fuel_level_pct) AS min_fuel,
        CASE WHEN MAX(engine_temp_celsius) > 110 THEN 'CRITICAL' WHEN MAX(engine_temp_celsius) > 105 THEN 'WARNING' ELSE 'LOW FUEL' END AS alert_level
        FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, reading_timestamp, TIMESTAMP '1970-01-01') - i * INTERVAL 15 MINUTE AS window_start
              FROM telemetry, range(0, 4) r(i))
        GROUP BY window_start, equipment_id
        HAVING CNT(engine_temp_celsius > 105) > 0 OR CNT(fuel_level_pct < 10 AND status IN ('operational', 'warning', 'critical')) > 0""",
    "j6_stream_idle_sessions": """WITH idle AS (SELECT * FROM silver_fleet_positions WHERE is_idling)
        SELECT vehicle_id, MIN(ping_timestamp) AS idle_from, MAX(ping_timestamp) + INTERVAL 6 HOUR AS idle_to, COUNT(*) AS idle_pings
        FROM (SELECT *, SUM(new) OVER (PARTITION BY vehicle_id ORDER BY ping_timestamp) AS s
              FROM (SELECT *, CASE WHEN ping_timestamp < lag(ping_timestamp) OVER (PARTITION BY vehicle_id ORDER BY ping_timestamp) + INTERVAL 6 HOUR
                              THEN 0 ELSE 1 END AS new FROM idle))
        GROUP BY vehicle_id, s
        HAVING MAX(ping_timestamp) + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', MAX(ping_timestamp)) FROM idle) - INTERVAL 1 DAY""",
    "j7_stream_latest": "SELECT equipment_id, site_name, status, engine_temp_celsius, reading_timestamp FROM tel_now",
    "j8_stream_refresh_mv": "SELECT * FROM gold_delivery_performance",
    "j9_stream_enrich": "SELECT CAST(ts AS DATE) AS day, division, COUNT(*) AS readings FROM ev GROUP BY 1, 2",
    # --- retrieval and evaluation
    "s1_chunks": f"SELECT doc_id, chunk_no, start, CAST(length(text) AS INT) AS n_chars, md5(text) AS digest FROM ({CHUNKS})",
    "s1_sections": """SELECT conv_id, section, COUNT(*) AS parts, TOTI(n) AS n_chars
        FROM (SELECT conv_id, CAST(0 AS INT) AS section, length(text) + 8 AS n FROM conversations
              UNION ALL SELECT conv_id, 1, length(role) + 8 FROM conversations) GROUP BY 1, 2""",
    "s2_keyword_topk": f"WITH {keyword(CHUNKS, 'doc_id, chunk_no', 5)} SELECT query_id, doc_id, chunk_no, score, rank FROM kw",
    "s3_nearest_in_group": f"WITH {vector(5, True)} SELECT * FROM vec",
    "s3_vector_topk": f"WITH {vector(5)} SELECT * FROM vec",
    "s3_vector_index": f"""WITH c AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS centre FROM embeddings WHERE vec_id % 50 = 0),
        s AS (SELECT c.query_id, e.vec_id, {COSINE} AS score FROM embeddings e CROSS JOIN c)
        SELECT query_id, vec_id, score, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s WHERE score IS NOT NULL)
        WHERE rank <= 10""",
    "s3_hybrid_topk": f"""WITH {keyword('SELECT doc_id, text FROM documents', 'doc_id', 20)}, {vector(20)},
        f AS (SELECT query_id, doc_id, RND(COALESCE(1.0::DOUBLE / (60 + k.rank), 0) + COALESCE(1.0::DOUBLE / (60 + v.rank), 0), 8) AS score
              FROM kw k FULL JOIN (SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS doc_id, rank FROM vec) v USING (query_id, doc_id))
        SELECT query_id, doc_id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM f)
        WHERE rank <= 10""",
    "s4_filtered_search": f"""WITH {keyword(CHUNKS, 'doc_id, chunk_no', 3,
        "WHERE lang IN ('en', 'fr') AND CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 3 = 1")} SELECT query_id, doc_id, chunk_no, score, rank FROM kw""",
    "s4_visible_documents": """SELECT principal, COUNT(DISTINCT doc_id) AS documents
        FROM (SELECT 'user-' || c_custkey AS principal, c_custkey % 5 AS g FROM customer)
        JOIN (SELECT doc_id, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 3 AS g FROM documents) USING (g) GROUP BY 1""",
    "s5_execution_match": "SELECT CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows, true AS is_match",
    "s6_eval_rollup": """SELECT run_id, evaluator, items, pass_rate_pct, mean_score, target_mean, target_pct,
        COALESCE(mean_score >= target_mean, pass_rate_pct >= target_pct) AS meets_target, change_pct,
        COALESCE(change_pct < 0, false) AS is_regression
        FROM (SELECT *, CAST(CASE evaluator WHEN 'coherence' THEN 80 ELSE 100 END AS DOUBLE) AS target_pct,
                     CASE evaluator WHEN 'coherence' THEN 4.0::DOUBLE END AS target_mean,
                     RND(pass_rate_pct - lag(pass_rate_pct) OVER (PARTITION BY evaluator ORDER BY run_id), 1) AS change_pct
              FROM (SELECT source AS run_id, evaluator, COUNT(*) AS items, SHARE(passed) AS pass_rate_pct, AVGR(score, 2) AS mean_score
                    FROM (SELECT source, 'coherence' AS evaluator, quality = 1 AS passed, CASE WHEN quality = 1 THEN 5.0::DOUBLE ELSE 2.0 END AS score
                          FROM labels JOIN documents USING (doc_id)
                          UNION ALL SELECT source, e, toxic = 0, NULL FROM labels JOIN documents USING (doc_id), (VALUES ('task_adherence'), ('violence')) v(e))
                    GROUP BY 1, 2))""",
}
