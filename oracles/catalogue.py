"""One SQL text per registered query."""

from __future__ import annotations

from oracles.views import VIEWS, with_views

# Views whose registered query returns exactly the view.
SAME = """
silver_fleet_positions gold_fleet_utilisation_daily gold_delivery_performance
gold_inventory_health gold_invoice_aging gold_site_operations_summary gold_supplier_scorecard
project_kpis safety_kpis fleet_kpis division_summary monthly_kpis exec_scorecard project_risk_matrix
financials_by_division safety_summary equipment_status procurement_analytics workforce_utilisation
compliance_dashboard
""".split()

SQL: dict[str, str] = {name: f"SELECT * FROM {name}" for name in SAME}

SQL["silver_deliveries"] = """SELECT * REPLACE (RND(cost_variance_pct, 6) AS cost_variance_pct), 'unit' AS unit, 'WH-0' AS warehouse_origin,
    'site store' AS received_by, CAST(year(delivery_date) AS VARCHAR) AS batch_id FROM silver_deliveries"""
SQL["silver_inventory"] = "SELECT *, 'unit' AS unit FROM silver_inventory"
SQL["silver_invoices"] = "SELECT *, 'AUD' AS currency, CAST(year(invoice_date) AS VARCHAR) AS batch_id FROM silver_invoices"
SQL["gold_inventory_health"] = "SELECT *, 'unit' AS unit FROM gold_inventory_health"

# --- projects ---------------------------------------------------------------
SQL |= {
    "q_pj_01": "SELECT project_name, division, budget_aud, actual_cost_aud, cost_variance_pct, spi, cpi, project_manager FROM financials WHERE status = 'red'",
    "q_pj_02": """SELECT division, COUNT(*) AS projects, RND(TOT(budget_aud, 4) / 1e9, 2) AS budget_b,
                  RND(TOT(actual_cost_aud, 4) / 1e9, 2) AS actuals_b, AVGR(spi, 3, 4) AS avg_spi, AVGR(cpi, 3, 4) AS avg_cpi
                  FROM financials GROUP BY 1""",
    "q_pj_03": """SELECT COUNT(*) AS total_projects, RND(TOT(budget_aud, 4) / 1e9, 2) AS total_budget_b,
                  RND(TOT(actual_cost_aud, 4) / 1e9, 2) AS total_actuals_b,
                  RND(DBL(SUM(DEC(actual_cost_aud, 4) - DEC(budget_aud, 4))) / 1e6, 1) AS variance_m,
                  AVGR(spi, 3, 4) AS avg_spi, AVGR(cpi, 3, 4) AS avg_cpi FROM financials""",
    "q_pj_04": """SELECT project_name, division, client, budget_aud, actual_cost_aud, status, spi, cpi FROM financials
                  ORDER BY budget_aud DESC, project_id, reporting_period LIMIT 10""",
    "q_pj_05": "SELECT project_name, division, spi, cpi, status, planned_completion FROM financials WHERE spi < 1.0",
    "q_pj_06": """SELECT project_manager, COUNT(*) AS projects, AVGR(cpi, 3, 4) AS avg_cpi, AVGR(spi, 3, 4) AS avg_spi,
                  CNT(status = 'red') AS red_projects FROM financials GROUP BY 1""",
    "q_pj_07": """SELECT state, COUNT(*) AS projects, RND(TOT(budget_aud, 4) / 1e9, 2) AS budget_b,
                  RND(DBL(SUM(DEC(actual_cost_aud, 4) - DEC(budget_aud, 4))) / 1e6, 1) AS overrun_m FROM financials GROUP BY 1""",
    "q_pj_08": """SELECT project_name, division, budget_aud, actual_cost_aud, cpi, RND(RATIO(budget_aud, cpi), 0) AS eac_aud,
                  RND(RATIO(budget_aud, cpi) - budget_aud, 0) AS forecast_overrun_aud FROM financials WHERE status = 'red'""",
    "q_pj_09": """SELECT COUNT(*) AS total_projects, RND(TOT(budget_aud, 4) / 1e6, 1) AS total_budget_m,
                  RND(TOT(actual_cost_aud, 4) / 1e6, 1) AS total_spent_m, AVGR(spi, 2, 4) AS avg_spi, AVGR(cpi, 2, 4) AS avg_cpi,
                  AVGR(pct_complete, 1, 4) AS avg_completion_pct, CNT(status = 'amber') AS at_risk_projects,
                  CNT(cpi < 0.9) AS over_budget_projects FROM financials""",
    "q_pj_10": """SELECT project_name, division, status, RND(budget_aud / 1e6, 1) AS budget_m, RND(actual_cost_aud / 1e6, 1) AS spent_m,
                  RND(cost_variance_pct, 1) AS cv_pct, spi, cpi, project_manager FROM financials
                  WHERE status = 'amber' OR cpi < 0.9 OR spi < 0.9""",
    "q_pj_11": """SELECT division, COUNT(*) AS projects, RND(TOT(budget_aud, 4) / 1e6, 1) AS total_budget_m,
                  RND(TOT(actual_cost_aud, 4) / 1e6, 1) AS total_spent_m, AVGR(spi, 2, 4) AS avg_spi, AVGR(cpi, 2, 4) AS avg_cpi,
                  AVGR(pct_complete, 1, 4) AS avg_completion, CNT(status = 'amber') AS at_risk FROM financials GROUP BY 1""",
    "q_pj_12": """SELECT project_name, division, RND(budget_aud / 1e6, 1) AS budget_m, RND(actual_cost_aud / 1e6, 1) AS actual_m,
                  RND((budget_aud - actual_cost_aud) / 1e6, 1) AS variance_m, RND(cost_variance_pct, 1) AS cv_pct, status, pct_complete
                  FROM financials""",
    "q_pj_13": """SELECT project_name, division, RND(budget_aud / 1e6, 1) AS budget_m, RND(actual_cost_aud / 1e6, 1) AS actual_m,
                  RND((actual_cost_aud - budget_aud) / 1e6, 1) AS overrun_m, cpi, spi, project_manager
                  FROM financials WHERE actual_cost_aud > budget_aud
                  ORDER BY actual_cost_aud - budget_aud DESC, project_id, reporting_period LIMIT 5""",
    "q_pj_14": """SELECT project_name, division, RND(budget_aud / 1e6, 1) AS budget_m, RND(actual_cost_aud / 1e6, 1) AS actual_m,
                  RND((actual_cost_aud - budget_aud) / 1e6, 1) AS overrun_m, RND(RATIO(budget_aud, cpi) / 1e6, 1) AS eac_m,
                  cpi, spi, project_manager FROM financials WHERE actual_cost_aud > budget_aud
                  ORDER BY actual_cost_aud - budget_aud DESC, project_id, reporting_period LIMIT 5""",
    "q_pj_15": """SELECT project_name, division, status, RND(budget_aud / 1e6, 1) AS budget_m, RND(actual_cost_aud / 1e6, 1) AS spent_m,
                  spi, cpi, pct_complete, project_manager FROM financials WHERE status = 'amber' OR cpi < 0.9 OR spi < 0.9""",
    "q_pj_16": """SELECT division, COUNT(*) AS projects, AVGR(spi, 2, 4) AS avg_spi, AVGR(cpi, 2, 4) AS avg_cpi,
                  RND(TOT(budget_aud, 4) / 1e6, 1) AS total_budget_m, CNT(status = 'amber') AS at_risk FROM financials GROUP BY 1""",
    "q_pj_17": """SELECT division, COUNT(*) AS projects, AVGR(pct_complete, 1, 4) AS avg_completion,
                  RND(MIN(pct_complete), 1) AS min_completion, RND(MAX(pct_complete), 1) AS max_completion FROM financials GROUP BY 1""",
    "q_pj_18": """SELECT project_manager, COUNT(*) AS total_projects, CNT(status = 'amber') AS at_risk, AVGR(cpi, 2, 4) AS avg_cpi,
                  AVGR(spi, 2, 4) AS avg_spi FROM financials GROUP BY 1 HAVING CNT(status = 'amber') > 0""",
    "q_pj_19": """SELECT division, COUNT(*) AS project_count, TOT(budget_aud, 4) AS total_budget, TOT(actual_cost_aud, 4) AS total_actual_cost,
                  TOT(earned_value_aud, 4) AS total_earned_value,
                  RND(RATIO(TOT(earned_value_aud, 4), TOT(planned_value_aud, 4)), 2) AS weighted_spi,
                  RND(RATIO(TOT(earned_value_aud, 4), TOT(actual_cost_aud, 4)), 2) AS weighted_cpi,
                  CNT(status = 'red') AS red_projects, CNT(status = 'amber') AS amber_projects FROM fin_now GROUP BY 1""",
    "q_pj_20": """SELECT project_id, project_name, division, project_manager, budget_aud, actual_cost_aud,
                  RND(RATIO(budget_aud, cpi), 0) AS eac_aud, budget_aud - RND(RATIO(budget_aud, cpi), 0) AS vac_aud, spi, cpi,
                  cost_variance_pct FROM fin_now WHERE status = 'red'""",
    "q_pj_21": """SELECT project_id, project_name, division, spi, cpi, planned_value_aud, earned_value_aud,
                  planned_value_aud - earned_value_aud AS schedule_variance_aud, planned_completion, status
                  FROM fin_now ORDER BY spi, project_id LIMIT 5""",
    "q_pj_22": """SELECT project_type, COUNT(*) AS project_count, TOT(budget_aud, 4) AS total_budget,
                  RND(RATIO(TOT(earned_value_aud, 4), TOT(planned_value_aud, 4)), 2) AS weighted_spi,
                  RND(RATIO(TOT(earned_value_aud, 4), TOT(actual_cost_aud, 4)), 2) AS weighted_cpi,
                  AVGR(cost_variance_pct, 1) AS avg_cost_variance_pct FROM fin_now WHERE division = 'ASIA' GROUP BY 1""",
    "q_pj_23": """SELECT project_manager, COUNT(*) AS at_risk_projects, TOT(budget_aud, 4) AS total_budget_at_risk,
                  AVGR(cpi, 2, 4) AS avg_cpi, AVGR(spi, 2, 4) AS avg_spi FROM fin_now WHERE status IN ('red', 'amber')
                  GROUP BY 1 HAVING COUNT(*) > 1""",
    "q_pj_24": """SELECT a.*, b.project_name AS lowest_cpi_project, b.cpi AS lowest_cpi
                  FROM (SELECT COUNT(*) AS project_count, CNT(status = 'red') AS red_count, CNT(status = 'amber') AS at_risk_count,
                               RND(TOT(budget_aud, 4), 2) AS total_budget, AVGR(cpi, 2, 4) AS avg_cpi FROM financials) a,
                       (SELECT project_name, cpi FROM financials ORDER BY cpi, project_id, reporting_period LIMIT 1) b""",
    "q_pj_25": """SELECT milestone_id, m.project_id, project_name, division, milestone_type, planned_date, actual_date, delay_days
                  FROM milestones m JOIN (SELECT DISTINCT project_id, project_name, division FROM financials) USING (project_id)
                  WHERE is_critical_path AND delay_days > 30""",
    "q_pj_26": """SELECT f.project_id, project_name, division, planned_completion, pct_complete, status FROM financials f
                  JOIN (SELECT project_id, MAX(reporting_period) AS m FROM financials GROUP BY 1) x
                    ON f.project_id = x.project_id AND reporting_period = m
                  WHERE planned_completion > DATE '2001-07-01' AND planned_completion <= DATE '2002-07-01'""",
    "q_pj_27": """SELECT division, avg_spi, dense_rank() OVER (ORDER BY avg_spi DESC) AS spi_rank
                  FROM (SELECT division, AVGR(spi, 4, 4) AS avg_spi FROM financials GROUP BY 1)""",
    "q_pj_28": """SELECT milestone_type, COUNT(*) AS milestones, SHARE(status = 'on_track') AS on_track_pct,
                  CNT(status = 'delayed') AS delayed FROM milestones GROUP BY 1""",
    "q_pj_29": """SELECT state, COUNT(*) AS projects, AVGR(cpi, 4, 4) AS avg_cpi FROM financials GROUP BY 1 ORDER BY avg_cpi, state LIMIT 1""",
    "q_pj_30": """SELECT division, COUNT(*) AS projects, CNT(status = 'red') AS red_projects, SHARE(status = 'red') AS red_share_pct,
                  RND(RATIO(TOT(CASE WHEN status = 'red' THEN budget_aud END, 4), TOT(budget_aud, 4)) * CAST(100 AS DOUBLE), 1) AS red_budget_share_pct
                  FROM fin_now GROUP BY 1""",
    "q_pj_31": """SELECT project_id, project_name, budget_aud, cpi, RND(RATIO(budget_aud, cpi), 0) AS eac_aud,
                  RND(budget_aud - RATIO(budget_aud, cpi), 0) AS vac_aud FROM fin_now WHERE division = 'EUROPE'""",
    "q_pj_32": """SELECT division, COALESCE(TOT(CASE WHEN status = 'red' THEN budget_aud END, 4), 0) AS budget_at_risk,
                  TOT(budget_aud, 4) AS total_budget, CNT(status = 'red') AS red_projects FROM fin_now GROUP BY 1""",
    "q_pj_33": """SELECT project_id, project_name, division, cost_variance_pct, cpi, status FROM fin_now
                  ORDER BY cost_variance_pct, project_id LIMIT 5""",
    "q_pj_34": """SELECT division, quarter, avg_spi, avg_cpi, incidents,
                  RND(avg_spi - lag(avg_spi) OVER w, 3) AS avg_spi_change, RND(avg_cpi - lag(avg_cpi) OVER w, 3) AS avg_cpi_change,
                  incidents - lag(incidents) OVER w AS incidents_change
                  FROM (SELECT division, date_trunc('quarter', reporting_period)::DATE AS quarter, AVGR(spi, 3, 4) AS avg_spi,
                               AVGR(cpi, 3, 4) AS avg_cpi FROM financials GROUP BY 1, 2)
                  FULL JOIN (SELECT division, date_trunc('quarter', incident_date)::DATE AS quarter, COUNT(*) AS incidents
                             FROM incidents GROUP BY 1, 2) USING (division, quarter)
                  WINDOW w AS (PARTITION BY division ORDER BY quarter)""",
    "q_pj_35": """SELECT COUNT(DISTINCT project_id) AS projects, RND(DBL(SUM(DEC(actual_cost_aud, 4) - DEC(budget_aud, 4))), 2) AS overrun_aud,
                  RND(PCT(SUM(DEC(actual_cost_aud, 4) - DEC(budget_aud, 4)), SUM(DEC(budget_aud, 4))), 1) AS overrun_pct
                  FROM financials WHERE state = 'NATION_7'""",
    "q_pj_36": """SELECT division, status, projects, RND(PCT(projects, SUM(projects) OVER (PARTITION BY division)), 1) AS share_pct
                  FROM (SELECT division, status, COUNT(*) AS projects FROM financials GROUP BY 1, 2)""",
    "q_pj_37": "SELECT division, TOT(budget_aud, 4) AS total_budget FROM financials GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
}

# --- safety, environment, quality -------------------------------------------
BRIEF = "incident_id, incident_date, site_name, division, incident_type, severity, injuries, lost_time_days"
SIG = "severity IN ('Critical', 'Serious')"
SQL |= {
    "q_sf_01": f"SELECT {BRIEF} FROM incidents WHERE status = 'open'",
    "q_sf_02": """SELECT division, severity, COUNT(*) AS incidents, TOTI(injuries) AS total_injuries, TOT(lost_time_days) AS total_lti_days
                  FROM incidents GROUP BY 1, 2""",
    "q_sf_03": """SELECT root_cause, COUNT(*) AS incidents, TOTI(injuries) AS injuries, AVGR(lost_time_days, 1) AS avg_lti_days
                  FROM incidents GROUP BY 1""",
    "q_sf_04": f"""SELECT site_name, division, COUNT(*) AS incidents, CNT({SIG}) AS critical_serious FROM incidents GROUP BY 1, 2
                  ORDER BY 3 DESC, 1, 2 LIMIT 15""",
    "q_sf_05": """SELECT date_trunc('month', incident_date)::DATE AS month, COUNT(*) AS incidents, TOTI(injuries) AS injuries
                  FROM incidents GROUP BY 1""",
    "q_sf_06": """SELECT incident_id, incident_date, site_name, division, incident_type, description, injuries, lost_time_days, root_cause,
                  corrective_action, status FROM incidents WHERE severity = 'Critical'""",
    "q_sf_07": """SELECT COUNT(*) AS total_incidents, CNT(severity = 'Critical') AS critical, CNT(severity = 'Serious') AS high,
                  CNT(is_near_miss) AS near_misses, RND(TOT(lost_time_days), 1) AS total_lti_days,
                  CNT(lost_time_days > 0 AND NOT is_near_miss) AS lti_count FROM incidents""",
    "q_sf_08": """SELECT date_trunc('month', incident_date)::DATE AS month, COUNT(*) AS total, CNT(severity = 'Critical') AS critical,
                  CNT(severity = 'Serious') AS serious, CNT(severity = 'Moderate') AS moderate, CNT(severity = 'Minor') AS minor,
                  CNT(is_near_miss) AS near_misses, RND(TOT(lost_time_days), 1) AS total_lti_days FROM incidents GROUP BY 1""",
    "q_sf_09": f"""SELECT root_cause, COUNT(*) AS incidents, RND(TOT(lost_time_days), 1) AS total_lti_days, TOTI(injuries) AS total_injuries
                  FROM incidents WHERE {SIG} GROUP BY 1""",
    "q_sf_10": """SELECT site_name, monitor_type, unit, COUNT(*) AS total_readings, CNT(is_exceedance) AS exceedances,
                  SHARE(is_exceedance) AS exceedance_rate_pct, RND(MAX(measurement_value), 1) AS max_reading,
                  AVGR(threshold_value, 1) AS threshold FROM emissions GROUP BY 1, 2, 3""",
    "q_sf_11": """SELECT project_name, f.division, COUNT(*) AS total_inspections, CNT(result = 'pass') AS passed, CNT(result = 'fail') AS failed,
                  RND(PCT(CNT(result = 'pass'), COUNT(*)), 1) AS pass_rate_pct,
                  RND(DBL(SUM(DEC(COALESCE(rework_cost_aud, 0), 4))), 2) AS total_rework_cost
                  FROM inspections q JOIN financials f ON q.project_id = f.project_id GROUP BY 1, 2""",
    "q_sf_11_safe": """SELECT project_name, f.division, COUNT(*) AS total_inspections, CNT(result = 'pass') AS passed, CNT(result = 'fail') AS failed,
                  RND(PCT(CNT(result = 'pass'), COUNT(*)), 1) AS pass_rate_pct,
                  RND(DBL(SUM(DEC(COALESCE(rework_cost_aud, 0), 4))), 2) AS total_rework_cost
                  FROM inspections q JOIN (SELECT DISTINCT project_id, project_name, division FROM financials) f
                  ON q.project_id = f.project_id GROUP BY 1, 2""",
    "q_sf_12": """SELECT incident_id, incident_date, shift, incident_type, severity, description, injuries, lost_time_days, root_cause, status
                  FROM incidents WHERE site_name = 'NATION_7'""",
    "q_sf_13": """SELECT site_name, COUNT(*) AS dust_readings, CNT(is_exceedance) AS exceedances, RND(MAX(measurement_value), 1) AS max_dust,
                  AVGR(threshold_value, 1) AS threshold, MAX(action_taken) AS latest_action
                  FROM emissions WHERE monitor_type IN ('dust_pm10', 'dust_pm2_5') GROUP BY 1 HAVING CNT(is_exceedance) > 0""",
    "q_sf_13_safe": """SELECT site_name, COUNT(*) AS dust_readings, CNT(is_exceedance) AS exceedances, RND(MAX(measurement_value), 1) AS max_dust,
                  AVGR(threshold_value, 1) AS threshold, arg_max(action_taken, (reading_date, reading_time, reading_id)) AS latest_action
                  FROM emissions WHERE monitor_type IN ('dust_pm10', 'dust_pm2_5') GROUP BY 1 HAVING CNT(is_exceedance) > 0""",
    "q_sf_14": f"""SELECT shift, COUNT(*) AS incidents, CNT({SIG}) AS serious, RND(TOT(lost_time_days), 1) AS lti_days,
                  CNT(is_near_miss) AS near_misses FROM incidents GROUP BY 1""",
    "q_sf_15": """SELECT inspection_id, f.project_name, i.site_name, inspection_type, discipline, defect_category, i.severity AS defect_severity,
                  rework_cost_aud, inspector, inspection_date
                  FROM inspections i LEFT JOIN financials f ON i.project_id = f.project_id
                  WHERE i.result = 'fail' AND i.inspection_type IN ('weld_test', 'concrete_test')""",
    "q_sf_15_safe": """SELECT inspection_id, project_name, site_name, inspection_type, discipline, defect_category, severity AS defect_severity,
                  rework_cost_aud, inspector, inspection_date
                  FROM inspections LEFT JOIN (SELECT DISTINCT project_id, project_name FROM financials) USING (project_id)
                  WHERE result = 'fail' AND inspection_type IN ('weld_test', 'concrete_test')""",
    "q_sf_16": """SELECT site_name, COUNT(*) AS night_noise_readings, CNT(is_exceedance) AS exceedances, AVGR(measurement_value, 1) AS avg_noise_db,
                  RND(MAX(measurement_value), 1) AS max_noise_db, AVGR(threshold_value, 1) AS limit_db
                  FROM emissions WHERE monitor_type = 'noise_db' AND reading_time >= '18:00' GROUP BY 1""",
    "q_sf_17": f"""SELECT division, strftime(incident_date, '%Y-%m') AS incident_month, COUNT(*) AS total_incidents, CNT({SIG}) AS significant_incidents,
                  CNT(lost_time_days > 0) AS lti_count, TOT(lost_time_days) AS total_lost_days, TOTI(injuries) AS total_injuries
                  FROM incidents WHERE incident_date >= DATE '2024-03-30' GROUP BY 1, 2""",
    "q_sf_18": """SELECT site_name, division, COUNT(*) AS incident_count, CNT(lost_time_days > 0) AS lti_count, TOT(lost_time_days) AS total_lost_days,
                  CNT(severity = 'Critical') AS critical_count, CNT(status IN ('open', 'investigating', 'overdue')) AS open_actions
                  FROM incidents WHERE year(incident_date) = 2024 GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "q_sf_19": """SELECT root_cause, COUNT(*) AS lti_count, TOT(lost_time_days) AS total_lost_days, AVGR(lost_time_days, 1) AS avg_lost_days_per_lti,
                  TOTI(injuries) AS total_injuries FROM incidents WHERE lost_time_days > 0 GROUP BY 1""",
    "q_sf_20": f"""SELECT {BRIEF}, description, root_cause, corrective_action, status FROM incidents
                  WHERE {SIG} AND status IN ('open', 'investigating')""",
    "q_sf_21": """SELECT division, severity, incident_count, RND(PCT(incident_count, SUM(incident_count) OVER (PARTITION BY division)), 1) AS pct_of_division
                  FROM (SELECT division, severity, COUNT(*) AS incident_count FROM incidents WHERE year(incident_date) = 2024 GROUP BY 1, 2)""",
    "q_sf_22": "SELECT division, month, total_incidents, near_misses, ltis, lost_time_days FROM safety_kpis WHERE month >= DATE '2023-12-30'",
    "q_sf_23": """SELECT division, TOTI(ltis) AS total_ltis, TOTI(total_incidents) AS total_incidents, TOT(lost_time_days) AS total_lost_days
                  FROM safety_kpis WHERE month = (SELECT MAX(month) FROM safety_kpis) GROUP BY 1""",
    "q_sf_24": """SELECT COUNT(*) AS total_incidents, CNT(status = 'open') AS open_incidents, TOT(lost_time_days) AS lost_days,
                  CNT(severity = 'Critical' AND status <> 'closed') AS critical_not_closed, CNT(is_near_miss) AS near_misses FROM incidents""",
    "q_sf_24_division": "SELECT division, COUNT(*) AS cnt FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "q_sf_24_serious": f"SELECT division, COUNT(*) AS cnt FROM incidents WHERE {SIG} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "q_sf_24_site": "SELECT site_name, COUNT(*) AS cnt FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "q_sf_24_type": "SELECT incident_type, COUNT(*) AS cnt FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "q_sf_24_critical": "SELECT incident_id, incident_date, site_name, severity FROM incidents WHERE severity = 'Critical'",
    "q_sf_24_rework": "SELECT RND(TOT(rework_cost_aud, 4), 2) AS total_rework_cost FROM inspections WHERE result = 'fail'",
    "q_sf_24_dust": """SELECT SHARE(is_exceedance) AS exceedance_rate_pct FROM emissions
                  WHERE site_name LIKE '%N_7%' AND monitor_type LIKE 'dust%'""",
    "q_sf_24_water": "SELECT site_name, measurement_value, threshold_value FROM emissions WHERE monitor_type LIKE 'water%' AND is_exceedance",
    "q_sf_25": """SELECT site_name, ltis, hours_worked, RND(RATIO(DBL(ltis) * 1e6, hours_worked), 2) AS ltifr,
                  RND(RATIO(DBL(r) * 1e6, hours_worked), 2) AS trifr
                  FROM (SELECT site_name, CNT(lost_time_days > 0) AS ltis, CNT(injuries > 0) AS r FROM incidents GROUP BY 1)
                  LEFT JOIN (SELECT site_name, TOT(hours_regular) + TOT(hours_overtime) AS hours_worked FROM timesheets GROUP BY 1) USING (site_name)""",
    "q_sf_25_division": """SELECT *, CASE WHEN ltifr > previous THEN 'rising' WHEN ltifr < previous THEN 'falling' WHEN ltifr = previous THEN 'flat' END AS trend
                  FROM (SELECT *, lag(ltifr) OVER (PARTITION BY division ORDER BY month) AS previous
                  FROM (SELECT division, month, ltis, hours_worked, RND(RATIO(DBL(ltis) * 1e6, hours_worked), 2) AS ltifr
                  FROM (SELECT division, date_trunc('month', incident_date)::DATE AS month, CNT(lost_time_days > 0) AS ltis FROM incidents GROUP BY 1, 2)
                  LEFT JOIN (SELECT division, date_trunc('month', work_date)::DATE AS month, TOT(hours_regular) + TOT(hours_overtime) AS hours_worked
                             FROM timesheets GROUP BY 1, 2) USING (division, month)))""",
    "q_sf_26": """SELECT site_name, COUNT(*) AS inspections, SHARE(result = 'pass') AS first_pass_rate_pct, SHARE(result = 'fail') AS rework_rate_pct
                  FROM inspections GROUP BY 1""",
    "q_sf_26_project": """SELECT project_id, COUNT(*) AS inspections, SHARE(result = 'pass') AS first_pass_rate_pct
                  FROM inspections GROUP BY 1""",
    "q_sf_27": """SELECT site_name, month, incidents, previous, incidents - previous AS change
                  FROM (SELECT *, lag(incidents) OVER (PARTITION BY site_name ORDER BY month) AS previous
                        FROM (SELECT site_name, date_trunc('month', incident_date)::DATE AS month, COUNT(*) AS incidents FROM incidents GROUP BY 1, 2))
                  WHERE incidents > previous""",
    "q_sf_28": """SELECT division, CNT(is_near_miss) AS near_misses, COUNT(*) AS incidents, SHARE(is_near_miss) AS near_miss_pct
                  FROM incidents GROUP BY 1""",
    "q_sf_29": """SELECT division, TOT(lost_time_days) AS lost_days, CNT(lost_time_days > 0) AS ltis FROM incidents
                  WHERE incident_date >= DATE '2024-04-01' AND incident_date < DATE '2024-07-01' GROUP BY 1""",
    "q_sf_30": """SELECT site_name, COUNT(*) AS incidents FROM incidents WHERE incident_date BETWEEN DATE '2024-05-31' AND DATE '2024-06-30'
                  GROUP BY 1 HAVING COUNT(*) > 3""",
    "q_sf_31": """SELECT CNT(incident_date >= DATE '2024-05-01' AND incident_date < DATE '2024-06-01') AS last_month,
                  CNT(severity = 'Critical' AND incident_date >= DATE '2024-04-01' AND incident_date < DATE '2024-07-01') AS critical_this_quarter,
                  CNT(severity = 'Critical' AND incident_date BETWEEN DATE '2023-12-30' AND DATE '2024-06-30') AS critical_six_months FROM incidents""",
    "q_sf_32": """SELECT root_cause, COUNT(*) AS incidents, TOT(lost_time_days) AS lost_days FROM incidents
                  WHERE incident_type = 'Equipment Failure' GROUP BY 1""",
    "q_sf_33": """SELECT division, COUNT(*) AS incidents, CNT(severity = 'Critical') AS critical, CNT(severity = 'Serious') AS serious,
                  CNT(severity = 'Moderate') AS moderate, CNT(severity = 'Minor') AS minor, CNT(lost_time_days > 0) AS ltis,
                  TOT(lost_time_days) AS lost_days, SHARE(status = 'closed') AS closed_pct
                  FROM incidents WHERE division IN ('ASIA', 'EUROPE') GROUP BY 1""",
    "q_sf_34": f"SELECT {BRIEF}, root_cause FROM incidents WHERE status = 'investigating'",
    "q_sf_35": "SELECT site_name, CNT(lost_time_days > 0) AS lti_count, TOT(lost_time_days) AS lti_days FROM incidents GROUP BY 1",
    "q_sf_36": "SELECT site_name, COUNT(*) AS failed, RND(TOT(rework_cost_aud, 4), 2) AS rework_cost_aud FROM inspections WHERE result = 'fail' GROUP BY 1",
    "q_sf_36_noise": """SELECT site_name, COUNT(*) AS exceedances FROM emissions WHERE monitor_type = 'noise_db' AND is_exceedance
                  AND reading_date >= DATE '2023-10-30' GROUP BY 1""",
    "q_sf_37": """WITH m AS (SELECT division, month, total_incidents AS n, lag(total_incidents) OVER (PARTITION BY division ORDER BY month) AS p FROM safety_kpis),
                  l AS (SELECT division, arg_max(n, month) AS latest_incidents, arg_max(p, month) AS previous_incidents FROM m GROUP BY 1)
                  SELECT division, 'falling' AS trend, latest_incidents, previous_incidents, open_critical FROM l
                  JOIN (SELECT division, COUNT(*) AS open_critical FROM incidents WHERE severity = 'Critical' AND status IN ('open', 'investigating') GROUP BY 1)
                  USING (division) WHERE latest_incidents < previous_incidents""",
}

# --- equipment --------------------------------------------------------------
UNIT = "equipment_id, equipment_type, site_name, division"
HYD = """CASE WHEN hydraulic_pressure_bar > 400 OR hydraulic_pressure_bar < 100 THEN 'critical'
         WHEN hydraulic_pressure_bar > 350 OR hydraulic_pressure_bar < 150 THEN 'warning'
         WHEN hydraulic_pressure_bar >= 200 THEN 'normal' ELSE 'low_normal' END"""
FUEL = "CASE WHEN fuel_level_pct < 10 THEN 'critical' WHEN fuel_level_pct <= 20 THEN 'low' WHEN fuel_level_pct <= 50 THEN 'fair' ELSE 'good' END"
DUE = "DATE '2024-01-30'"
ONE = "(SELECT DISTINCT equipment_id, equipment_type, manufacturer, site_name AS site FROM telemetry)"
SQL |= {
    "q_eq_01": f"SELECT {UNIT}, engine_temp_celsius, fuel_level_pct, status FROM telemetry WHERE status IN ('critical', 'warning')",
    "q_eq_02": "SELECT division, status, COUNT(*) AS units FROM telemetry GROUP BY 1, 2",
    "q_eq_03": f"SELECT {UNIT}, maintenance_due_date, operating_hours, status FROM telemetry WHERE maintenance_due_date < {DUE}",
    "q_eq_04": """SELECT equipment_type, COUNT(*) AS units, AVGR(engine_temp_celsius, 1, 3) AS avg_temp_c, AVGR(fuel_level_pct, 1) AS avg_fuel_pct
                  FROM telemetry GROUP BY 1""",
    "q_eq_05": "SELECT equipment_id, equipment_type, site_name, fuel_level_pct, status FROM telemetry WHERE fuel_level_pct < 20",
    "q_eq_06": f"SELECT {UNIT}, operating_hours, status FROM telemetry ORDER BY operating_hours DESC, equipment_id, status LIMIT 20",
    "q_eq_07": """SELECT equipment_id, equipment_type, manufacturer, site_name, status, engine_temp_celsius, hydraulic_pressure_bar, fuel_level_pct,
                  operating_hours, maintenance_due_date FROM tel_now""",
    "q_eq_08": """SELECT equipment_type, manufacturer, COUNT(DISTINCT work_order_id) AS work_orders, RND(TOT(cost_aud), 2) AS total_cost_aud,
                  RND(TOT(parts_cost_aud), 2) AS parts_aud, RND(TOT(labour_cost_aud), 2) AS labour_aud, RND(TOT(downtime_hours), 1) AS total_downtime_hrs
                  FROM maintenance_log m JOIN telemetry t ON m.equipment_id = t.equipment_id WHERE m.status = 'completed' GROUP BY 1, 2""",
    "q_eq_08_safe": f"""SELECT equipment_type, manufacturer, COUNT(DISTINCT work_order_id) AS work_orders, RND(TOT(cost_aud), 2) AS total_cost_aud,
                  RND(TOT(parts_cost_aud), 2) AS parts_aud, RND(TOT(labour_cost_aud), 2) AS labour_aud, RND(TOT(downtime_hours), 1) AS total_downtime_hrs
                  FROM maintenance_log JOIN {ONE} USING (equipment_id) WHERE status = 'completed' GROUP BY 1, 2""",
    "q_eq_09": """SELECT manufacturer, equipment_type, COUNT(*) AS breakdowns, RND(TOT(cost_aud), 2) AS breakdown_cost_aud,
                  AVGR(downtime_hours, 1) AS avg_downtime_hrs, RND(TOT(downtime_hours), 1) AS total_downtime_hrs
                  FROM maintenance_log m JOIN telemetry t ON m.equipment_id = t.equipment_id WHERE maintenance_type = 'breakdown' GROUP BY 1, 2""",
    "q_eq_09_safe": f"""SELECT manufacturer, equipment_type, COUNT(*) AS breakdowns, RND(TOT(cost_aud), 2) AS breakdown_cost_aud,
                  AVGR(downtime_hours, 1) AS avg_downtime_hrs, RND(TOT(downtime_hours), 1) AS total_downtime_hrs
                  FROM maintenance_log JOIN {ONE} USING (equipment_id) WHERE maintenance_type = 'breakdown' GROUP BY 1, 2""",
    "q_eq_10": f"""SELECT DISTINCT equipment_id, equipment_type, manufacturer, site_name, maintenance_due_date,
                  CAST(date_diff('day', maintenance_due_date, {DUE}) AS INT) AS days_overdue FROM tel_now WHERE maintenance_due_date < {DUE}""",
    "q_eq_11": """SELECT maintenance_type, COUNT(*) AS work_orders, RND(TOT(cost_aud), 2) AS total_cost_aud, AVGR(cost_aud, 2) AS avg_cost_aud,
                  RND(TOT(downtime_hours), 1) AS total_downtime_hrs, AVGR(downtime_hours, 1) AS avg_downtime_hrs
                  FROM maintenance_log WHERE status = 'completed' GROUP BY 1""",
    "q_eq_12": """SELECT work_order_id, m.equipment_id, equipment_type, manufacturer, t.site_name, maintenance_type, description, cost_aud,
                  parts_cost_aud, labour_cost_aud, downtime_hours FROM maintenance_log m JOIN telemetry t ON m.equipment_id = t.equipment_id
                  WHERE m.status = 'completed' ORDER BY cost_aud DESC, work_order_id, t.site_name LIMIT 10""",
    "q_eq_12_safe": f"""SELECT work_order_id, equipment_id, equipment_type, manufacturer, site AS site_name, maintenance_type, description, cost_aud,
                  parts_cost_aud, labour_cost_aud, downtime_hours FROM maintenance_log JOIN {ONE} USING (equipment_id)
                  WHERE status = 'completed' ORDER BY cost_aud DESC, work_order_id LIMIT 10""",
    "q_eq_13": """SELECT equipment_type, manufacturer, COUNT(DISTINCT equipment_id) AS fleet_count, AVGR(fuel_consumption_lph, 1, 3) AS avg_fuel_lph,
                  RND(MAX(fuel_consumption_lph), 1) AS max_fuel_lph, AVGR(fuel_level_pct, 1) AS avg_fuel_level_pct FROM telemetry GROUP BY 1, 2""",
    "q_eq_14": """SELECT site_name, COUNT(DISTINCT equipment_id) AS total_equipment, CNT(status = 'operational') AS operational, CNT(status = 'warning') AS warning,
                  CNT(status = 'critical') AS critical, CNT(status = 'maintenance') AS in_maintenance,
                  RND(PCT(CNT(status = 'operational'), COUNT(DISTINCT equipment_id)), 1) AS availability_pct FROM tel_now GROUP BY 1""",
    "q_eq_15": """SELECT division, COUNT(*) AS total_units, CNT(status = 'operational') AS operational, CNT(status = 'warning') AS warning,
                  CNT(status = 'critical') AS critical, CNT(status = 'maintenance') AS maintenance FROM telemetry GROUP BY 1""",
    "q_eq_16": """SELECT division, equipment_type, COUNT(*) AS total_units, CNT(status = 'operational') AS active_units,
                  CNT(status = 'maintenance') AS in_maintenance, CNT(status = 'idle') AS idle_units,
                  RND(RATIO(SUM(operating_hours), COUNT(*)), 0) AS avg_operating_hours, AVGR(engine_temp_celsius, 1, 3) AS avg_engine_temp
                  FROM telemetry WHERE status <> 'decommissioned' GROUP BY 1, 2""",
    "q_eq_17": f"""SELECT {UNIT}, engine_temp_celsius, CASE WHEN engine_temp_celsius > 110 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level,
                  fuel_level_pct, operating_hours, status FROM telemetry WHERE engine_temp_celsius > 105 AND status = 'operational'""",
    "q_eq_18": f"""SELECT {UNIT}, maintenance_due_date, CAST(date_diff('day', maintenance_due_date, {DUE}) AS INT) AS days_overdue,
                  CASE WHEN date_diff('day', maintenance_due_date, {DUE}) > 7 THEN 'HIGH' ELSE 'MEDIUM' END AS priority,
                  operating_hours, engine_temp_celsius, status FROM telemetry
                  WHERE maintenance_due_date < {DUE} AND status IN ('operational', 'idle')""",
    "q_eq_19": f"""SELECT division, COUNT(*) AS total_fleet, CNT(status = 'operational') AS active_count, SHARE(status = 'operational') AS utilisation_pct,
                  CNT(maintenance_due_date < {DUE}) AS overdue_maintenance_count FROM telemetry GROUP BY 1""",
    "q_eq_20": f"""SELECT site_name, COUNT(*) AS equipment_count, CNT(status = 'operational') AS active, CNT(engine_temp_celsius > 105) AS temp_alerts,
                  CNT(maintenance_due_date < {DUE}) AS overdue_maintenance, AVGR(fuel_level_pct, 1) AS avg_fuel_level
                  FROM telemetry WHERE division = 'AMERICA' GROUP BY 1""",
    "q_eq_21": "SELECT * FROM fleet_kpis",
    "q_eq_21_breakdowns": "SELECT * FROM fleet_kpis WHERE breakdown_count > 0",
    "q_eq_22": "SELECT COUNT(*) AS critical_readings, COUNT(DISTINCT equipment_id) AS critical_units FROM telemetry WHERE status = 'critical'",
    "q_eq_22_breakdown": """SELECT RND(TOT(cost_aud), 2) AS breakdown_cost_aud, AVGR(downtime_hours, 1) AS avg_downtime_hrs
                  FROM maintenance_log WHERE maintenance_type = 'breakdown'""",
    "q_eq_22_maker": """SELECT manufacturer, COUNT(*) AS cnt FROM maintenance_log m JOIN telemetry t ON m.equipment_id = t.equipment_id
                  WHERE maintenance_type = 'breakdown' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "q_eq_22_due": f"""SELECT DISTINCT equipment_id, equipment_type, site_name, maintenance_due_date FROM telemetry
                  WHERE maintenance_due_date BETWEEN {DUE} AND {DUE} + 7""",
    "q_eq_23": """SELECT equipment_id, equipment_type, operating_hours, COALESCE(c, 0) AS cost_aud, RND(RATIO(COALESCE(c, 0), operating_hours), 2) AS cost_per_hour
                  FROM (SELECT equipment_id, equipment_type, MAX(operating_hours) AS operating_hours FROM telemetry GROUP BY 1, 2)
                  LEFT JOIN (SELECT equipment_id, TOT(cost_aud) AS c FROM maintenance_log GROUP BY 1) USING (equipment_id)""",
    "q_eq_24": f"""SELECT equipment_id, site_name, hydraulic_pressure_bar, {HYD} AS pressure_band FROM telemetry
                  WHERE {HYD} IN ('warning', 'critical')""",
    "q_eq_25": f"""WITH s AS (SELECT *, RND(least(DBL(operating_hours) / CAST(20000 AS DOUBLE), CAST(1 AS DOUBLE)) * CAST(40 AS DOUBLE)
                        + least(greatest(engine_temp_celsius - CAST(70 AS DOUBLE), CAST(0 AS DOUBLE)), CAST(60 AS DOUBLE)) / CAST(60 AS DOUBLE) * CAST(40 AS DOUBLE)
                        + CASE WHEN maintenance_due_date < {DUE} THEN CAST(20 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 1) AS failure_score FROM tel_now),
                  b AS (SELECT * FROM s ORDER BY failure_score DESC, equipment_id LIMIT 10)
                  SELECT equipment_id, equipment_type, site_name, status, operating_hours, engine_temp_celsius, failure_score,
                  COALESCE(n, 0) AS site_equipment_incidents FROM b
                  LEFT JOIN (SELECT site_name, COUNT(*) AS n FROM incidents WHERE incident_type = 'Equipment Failure' GROUP BY 1) USING (site_name)""",
    "q_eq_26": "SELECT equipment_id, site_name, operating_hours, status FROM tel_now WHERE equipment_type = 'excavator'",
    "q_eq_27": """SELECT division, COUNT(DISTINCT equipment_id) AS units,
                  COUNT(DISTINCT CASE WHEN status = 'operational' THEN equipment_id END) AS active_units FROM tel_now GROUP BY 1""",
    "q_eq_28": """SELECT site_name, COUNT(DISTINCT equipment_id) AS alert_units FROM tel_now WHERE status IN ('warning', 'critical')
                  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q_eq_29": """SELECT division, status, units, RND(PCT(units, SUM(units) OVER (PARTITION BY division)), 1) AS share_pct
                  FROM (SELECT division, status, COUNT(*) AS units FROM tel_now GROUP BY 1, 2)""",
    "q_eq_30": """SELECT equipment_id, site_name, fuel_level_pct, status FROM telemetry
                  WHERE fuel_level_pct < 10 AND status IN ('operational', 'warning', 'critical')""",
    "q_eq_31": f"""SELECT equipment_id, equipment_type, status, engine_temp_celsius, fuel_level_pct, {FUEL} AS fuel_band, {HYD} AS pressure_band,
                  CASE WHEN operating_hours > 10000 THEN 'major_review' WHEN operating_hours % 1000 = 0 THEN 'major'
                       WHEN operating_hours % 250 = 0 THEN 'minor' ELSE 'none' END AS service_due FROM tel_now WHERE site_name = 'NATION_7'""",
    "q_eq_32": f"""SELECT *, dense_rank() OVER (ORDER BY availability_pct) AS availability_rank, dense_rank() OVER (ORDER BY overdue_units DESC) AS overdue_rank
                  FROM (SELECT division, SHARE(status = 'operational') AS availability_pct,
                               CNT(maintenance_due_date < {DUE} AND status IN ('operational', 'warning', 'critical')) AS overdue_units FROM tel_now GROUP BY 1)""",
    "q_eq_33": f"""SELECT manufacturer, RND(TOT(cost_aud), 2) AS cost_aud, RND(TOT(downtime_hours), 1) AS downtime_hrs, COUNT(*) AS work_orders
                  FROM maintenance_log JOIN {ONE} USING (equipment_id) GROUP BY 1""",
    "q_eq_34": f"""SELECT equipment_type, operating_hours, COALESCE(b, 0) AS breakdowns, RND(RATIO(operating_hours, b), 1) AS mtbf_hours,
                  RND(RATIO(d, b), 1) AS mttr_hours
                  FROM (SELECT equipment_type, TOTI(h) AS operating_hours FROM
                        (SELECT equipment_type, equipment_id, MAX(operating_hours) AS h FROM telemetry GROUP BY 1, 2) GROUP BY 1)
                  LEFT JOIN (SELECT equipment_type, COUNT(*) AS b, TOT(downtime_hours) AS d FROM maintenance_log JOIN {ONE} USING (equipment_id)
                             WHERE maintenance_type = 'breakdown' GROUP BY 1) USING (equipment_type)""",
    "q_eq_35": f"""SELECT CASE WHEN engine_temp_celsius > 110 THEN 'CRITICAL' WHEN engine_temp_celsius > 95 THEN 'WARNING' ELSE 'NORMAL' END AS temperature,
                  {FUEL} AS fuel, {HYD} AS pressure,
                  CASE WHEN status IN ('operational', 'warning', 'critical') THEN 'in_service' ELSE 'out_of_service' END AS service,
                  COUNT(*) AS readings FROM telemetry GROUP BY ALL""",
}

# --- procurement ------------------------------------------------------------
RISK = "availability IN ('limited', 'out_of_stock')"
RISING = "price_trend = 'increasing'"
LEAD = "RND(RATIO(SUM(lead_time_days), COUNT(lead_time_days)), 0)"
RISK_ITEMS = f"""(SELECT supplier AS supplier_name, category, COUNT(*) AS risk_materials, DBL(SUM(spend)) AS risk_spend_aud
                 FROM materials WHERE {RISK} GROUP BY 1, 2)"""
SQL |= {
    "q_pr_01": f"SELECT material_name, category, supplier, unit_price_aud, unit, availability FROM materials WHERE {RISING}",
    "q_pr_02": f"SELECT material_name, category, supplier, unit_price_aud, lead_time_days, price_trend, availability FROM materials WHERE {RISK}",
    "q_pr_03": f"SELECT category, COUNT(*) AS materials, AVGR(unit_price_aud, 2) AS avg_price, {LEAD} AS avg_lead_days FROM materials GROUP BY 1",
    "q_pr_04": "SELECT material_name, supplier, unit_price_aud, unit, lead_time_days, price_trend, availability FROM materials WHERE category = 'PROMO'",
    "q_pr_05": "SELECT material_name, category, supplier, lead_time_days, availability, price_trend FROM materials WHERE lead_time_days > 30",
    "q_pr_06": """SELECT material_name, category, supplier, unit_price_aud, unit, last_order_qty, DBL(spend) AS estimated_spend_aud
                  FROM materials ORDER BY spend DESC, material_id LIMIT 20""",
    "q_pr_07": f"""SELECT supplier, category, COUNT(*) AS orders, RND(TOT(total_cost_aud), 2) AS total_spend_aud, AVGR(unit_price_aud, 2) AS avg_unit_price,
                  {LEAD} AS avg_lead_days FROM materials GROUP BY 1, 2""",
    "q_pr_08": f"""SELECT material_name, category, supplier, unit_price_aud, unit, lead_time_days, price_trend, availability FROM materials
                  WHERE {RISING} AND {RISK}""",
    "q_pr_09": """SELECT supplier, supplier_score, supplier_tier, deliveries, delivery_spend_aud, delivery_damage_rate_pct, cost_discrepancy_rate_pct,
                  invoices, invoiced_aud, invoice_overdue_pct FROM gold_supplier_scorecard""",
    "q_pr_10": """SELECT supplier, material_name, price_trend, AVGR(unit_price_aud, 2) AS avg_price_aud, RND(MIN(unit_price_aud), 2) AS min_price,
                  RND(MAX(unit_price_aud), 2) AS max_price, COUNT(*) AS orders FROM materials WHERE category = 'PROMO' GROUP BY 1, 2, 3""",
    "q_pr_11": """SELECT warehouse_name, region, material, on_hand_qty, reorder_point, stock_status, days_since_replenishment
                  FROM gold_inventory_health WHERE stock_status IN ('out_of_stock', 'below_reorder')""",
    "q_pr_12": """SELECT project_name, f.division, COUNT(*) AS orders, RND(TOT(total_cost_aud), 2) AS procurement_spend_aud,
                  COUNT(DISTINCT supplier) AS unique_suppliers, COUNT(DISTINCT category) AS material_categories
                  FROM project_materials m JOIN financials f ON m.project_id = f.project_id GROUP BY 1, 2""",
    "q_pr_12_safe": """SELECT project_name, f.division, COUNT(*) AS orders, RND(TOT(total_cost_aud), 2) AS procurement_spend_aud,
                  COUNT(DISTINCT supplier) AS unique_suppliers, COUNT(DISTINCT category) AS material_categories
                  FROM project_materials m JOIN (SELECT DISTINCT project_id, project_name, division FROM financials) f
                  ON m.project_id = f.project_id GROUP BY 1, 2""",
    "q_pr_13": """SELECT division, RND(b / 1e6, 1) AS total_budget_m, RND(COALESCE(c, 0) / 1e6, 2) AS procurement_m,
                  RND(RATIO(COALESCE(c, 0) * CAST(100 AS DOUBLE), b), 1) AS procurement_pct_of_budget
                  FROM (SELECT division, TOT(budget_aud, 4) AS b FROM financials GROUP BY 1)
                  LEFT JOIN (SELECT division, TOT(total_cost_aud) AS c FROM materials GROUP BY 1) USING (division)""",
    "q_pr_14": """SELECT supplier, supplier_score, supplier_tier, delivery_damage_rate_pct, cost_discrepancy_rate_pct, disputed_invoices, invoice_overdue_pct
                  FROM gold_supplier_scorecard WHERE supplier_tier = 'D - Review Required'""",
    "q_pr_15": """SELECT region, warehouse_name, CNT(stock_status = 'out_of_stock') AS out_of_stock_items, CNT(stock_status = 'below_reorder') AS below_reorder_items,
                  CNT(stock_status = 'healthy') AS healthy_items, CNT(stock_status = 'overstocked') AS overstocked_items FROM gold_inventory_health GROUP BY 1, 2""",
    "q_pr_16": """SELECT RND(TOT(unit_price_aud), 2) AS total_unit_prices,
                  RND(RATIO(SUM(lead_time_days) FILTER (WHERE category = 'PROMO'), CNT(category = 'PROMO')), 0) AS avg_lead_days_of_category FROM materials""",
    "q_pr_16_tier": "SELECT supplier_tier, COUNT(*) AS suppliers FROM gold_supplier_scorecard GROUP BY 1",
    "q_pr_16_warehouse": """SELECT warehouse_name, COUNT(*) AS cnt FROM gold_inventory_health WHERE stock_status = 'below_reorder'
                  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "q_pr_17": f"""SELECT category, COUNT(*) AS material_count, DBL(SUM(spend)) AS estimated_spend_aud, AVGR(unit_price_aud, 2) AS avg_unit_price,
                  {LEAD} AS avg_lead_time_days, CNT({RISING}) AS rising_price_count, CNT({RISK}) AS supply_risk_count FROM materials GROUP BY 1""",
    "q_pr_18": f"""SELECT supplier, COUNT(*) AS materials_supplied, AVGR(unit_price_aud, 2) AS avg_unit_price, {LEAD} AS avg_lead_time_days,
                  DBL(SUM(spend)) AS total_estimated_spend, CNT({RISING}) AS rising_prices, CNT(availability = 'good') AS in_stock_count,
                  CNT({RISK}) AS risk_items FROM materials GROUP BY 1""",
    "q_pr_19": f"""SELECT material_id, material_name, category, supplier, unit_price_aud, unit, lead_time_days, availability, price_trend, last_order_date,
                  last_order_qty, DBL(spend) AS last_order_value_aud FROM materials WHERE {RISK}""",
    "q_pr_20": """SELECT category, supplier, material_count, RND(s, 1) AS pct_of_category, supplier_spend_in_category
                  FROM (SELECT *, PCT(material_count, SUM(material_count) OVER (PARTITION BY category)) AS s
                        FROM (SELECT category, supplier, COUNT(*) AS material_count, DBL(SUM(spend)) AS supplier_spend_in_category FROM materials GROUP BY 1, 2))
                  WHERE s > 2""",
    "q_pr_20_division": """SELECT category, division, material_count, RND(s, 1) AS pct_of_category, supplier_spend_in_category
                  FROM (SELECT *, PCT(material_count, SUM(material_count) OVER (PARTITION BY category)) AS s
                        FROM (SELECT category, division, COUNT(*) AS material_count, DBL(SUM(spend)) AS supplier_spend_in_category FROM materials GROUP BY 1, 2))
                  WHERE s > 20""",
    "q_pr_20_site": """SELECT category, site_name, material_count, RND(s, 1) AS pct_of_category, supplier_spend_in_category
                  FROM (SELECT *, PCT(material_count, SUM(material_count) OVER (PARTITION BY category)) AS s
                        FROM (SELECT category, site_name, COUNT(*) AS material_count, DBL(SUM(spend)) AS supplier_spend_in_category FROM materials GROUP BY 1, 2))
                  WHERE s > 4""",
    "q_pr_21": f"""SELECT material_id, material_name, category, supplier, unit_price_aud, unit, lead_time_days, price_trend, availability, last_order_date
                  FROM materials WHERE lead_time_days > 30 AND {RISING}""",
    "q_pr_22": "SELECT * FROM exec_scorecard",
    "q_pr_22_expiring": "SELECT * FROM exec_scorecard WHERE contract_status = 'Expiring Soon'",
    "q_pr_22_review": "SELECT * FROM exec_scorecard WHERE contract_status IN ('Under Review', 'Expiring Soon') OR quality_score < 3.0",
    "q_pr_23": f"""SELECT category, material_name, supplier, unit_price_aud, lead_time_days, price_trend, availability, DBL(spend) AS est_spend_aud
                  FROM materials WHERE {RISK} OR ({RISING} AND lead_time_days > 30)""",
    "q_pr_24": f"""SELECT supplier_name, category, quality_score, contract_status, risk_materials, risk_spend_aud
                  FROM exec_scorecard JOIN {RISK_ITEMS} USING (supplier_name, category) WHERE quality_score < 3.0""",
    "q_pr_25": """SELECT material_id, material_name, supplier, CAST(last_order_qty AS BIGINT) AS qty, unit_price_aud, market_price_aud,
                  DBL(spend) AS internal_cost_aud, DBL(DEC(market_price_aud) * CAST(last_order_qty AS DECIMAL(10,0))) AS market_cost_aud,
                  unit_price_aud > market_price_aud AS overpaying
                  FROM materials JOIN (SELECT p_type AS category, AVGR(p_retailprice, 2) AS market_price_aud FROM part GROUP BY 1) USING (category)
                  WHERE lead_time_days = 21""",
    "q_pr_26": "SELECT material_id, material_name, supplier, last_order_date FROM materials WHERE last_order_date < DATE '2001-07-01' - 90",
    "q_pr_27": "SELECT aging_bucket, payment_risk, COUNT(*) AS invoices, TOT(total_aud, 3) AS total_aud FROM gold_invoice_aging GROUP BY 1, 2",
    "q_pr_27_overdue": "SELECT supplier, COUNT(*) AS invoices, TOT(total_aud, 3) AS overdue_aud FROM gold_invoice_aging WHERE is_overdue GROUP BY 1",
    "q_pr_27_damage": "SELECT supplier, COUNT(*) AS deliveries, SHARE(is_damaged) AS damage_rate_pct FROM silver_deliveries GROUP BY 1",
    "q_pr_28": f"""SELECT *, dense_rank() OVER (ORDER BY rising_materials DESC) AS rising_rank
                  FROM (SELECT supplier, CNT({RISING}) AS rising_materials, COUNT(*) AS materials FROM materials GROUP BY 1)""",
    "q_pr_29": """SELECT material_name, category, COUNT(*) AS offers, MIN(unit_price_aud) AS best_price, MAX(unit_price_aud) AS worst_price,
                  MIN(lead_time_days) AS best_lead_days, arg_min(supplier, (unit_price_aud, lead_time_days, supplier)) AS best_supplier
                  FROM materials GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "q_pr_30": """SELECT category, MAX(lead_time_days) AS longest_lead_days, COUNT(DISTINCT supplier) AS suppliers, MAX(unit_price_aud) AS highest_price
                  FROM materials GROUP BY 1""",
    "q_pr_30_top": """SELECT material_id, material_name, category, supplier, unit_price_aud FROM materials
                  ORDER BY unit_price_aud DESC, material_id LIMIT 10""",
    "q_pr_31": "SELECT * FROM exec_scorecard WHERE contract_status = 'Expiring Soon' AND total_spend_aud > 1000000",
    "q_pr_31_rank": """SELECT *, dense_rank() OVER (ORDER BY avg_quality DESC) AS quality_rank
                  FROM (SELECT supplier_name, AVGR(quality_score, 2) AS avg_quality FROM exec_scorecard GROUP BY 1)""",
    "q_pr_32": f"""SELECT supplier_name, category, total_spend_aud, quality_score, risk_materials, risk_spend_aud
                  FROM exec_scorecard JOIN {RISK_ITEMS} USING (supplier_name, category) WHERE total_spend_aud > 1000000""",
    "q_pr_33": """SELECT project_id, TOT(total_cost_aud) AS spend_aud, COUNT(*) AS orders FROM project_materials GROUP BY 1
                  ORDER BY 2 DESC, 1 LIMIT 5""",
    "q_pr_33_category": "SELECT TOT(total_cost_aud) AS spend_aud, COUNT(*) AS materials FROM materials WHERE category = 'PROMO'",
    "q_pr_34": f"""SELECT CASE WHEN lead_time_days > 60 THEN 'critical' WHEN lead_time_days > 30 THEN 'long' ELSE 'normal' END AS lead_band,
                  {RISK} AS supply_risk, {RISING} AND ({RISK} OR lead_time_days > 30) AS procurement_risk, COUNT(*) AS materials,
                  SHARE({RISING}) AS rising_pct FROM materials GROUP BY 1, 2, 3""",
}

# --- workforce --------------------------------------------------------------
HOURS = "DEC(hours_regular) + DEC(hours_overtime)"
EXPECTED = "DBL(CAST(hours_regular AS DECIMAL(9,2)) * CAST(hourly_rate_aud AS DECIMAL(9,2)) + CAST(hours_overtime AS DECIMAL(9,2)) * CAST(hourly_rate_aud AS DECIMAL(9,2)) * CAST(1.5 AS DECIMAL(4,2)))"
SQL |= {
    "q_wf_01": f"""SELECT site_name, TOT(hours_overtime) AS overtime_hours, RND(RATIO(TOT(hours_overtime), TOT({HOURS})) * CAST(100 AS DOUBLE), 1) AS overtime_pct,
                  RND(RATIO(TOT(hours_overtime), TOT({HOURS})) * CAST(100 AS DOUBLE), 1) > 20 AS excessive FROM timesheets GROUP BY 1""",
    "q_wf_02": """SELECT site_name, COUNT(DISTINCT employee_id) AS workers, COUNT(*) AS shifts, TOT(total_cost_aud, 4) AS cost_aud
                  FROM timesheets WHERE NOT is_inducted GROUP BY 1""",
    "q_wf_03": f"""SELECT project_id, TOT(total_cost_aud, 4) AS labour_cost_aud, TOT({HOURS}) AS hours, COUNT(DISTINCT employee_id) AS workers
                  FROM timesheets GROUP BY 1""",
    "q_wf_04": f"""SELECT role, AVGR(hours_regular, 2) AS avg_regular, AVGR(hours_overtime, 2) AS avg_overtime,
                  RND(RATIO(TOT({HOURS}), COUNT(*)), 2) AS avg_hours FROM timesheets GROUP BY 1""",
    "q_wf_05": f"""SELECT timesheet_id, employee_id, total_cost_aud, {EXPECTED} AS expected_cost_aud FROM timesheets
                  WHERE abs(total_cost_aud - {EXPECTED}) > 0.01 OR hours_regular > CAST(7.6 AS DOUBLE)""",
    "q_wf_06": """SELECT division, TOT(hours_overtime) AS overtime_hours,
                  DBL(SUM(DEC(hours_overtime) * CAST(hourly_rate_aud AS DECIMAL(9,2)) * CAST(1.5 AS DECIMAL(2,1)))) AS overtime_cost_aud
                  FROM timesheets WHERE work_date >= DATE '2024-01-01' AND work_date < DATE '2024-04-01' GROUP BY 1""",
}

# --- cross-domain -----------------------------------------------------------
OPEN = "status IN ('open', 'investigating')"
SQL |= {
    "q_x_01": """SELECT f.division, COUNT(DISTINCT project_id) AS projects, AVGR(cpi, 2, 4) AS avg_cpi, AVGR(spi, 2, 4) AS avg_spi,
                 COUNT(DISTINCT incident_id) AS incidents, TOT(lost_time_days) AS lti_days
                 FROM financials f LEFT JOIN incidents i ON f.division = i.division GROUP BY 1""",
    "q_x_01_safe": """SELECT division, projects, avg_cpi, avg_spi, COALESCE(n, 0) AS incidents, lti_days
                 FROM (SELECT division, COUNT(DISTINCT project_id) AS projects, AVGR(cpi, 2, 4) AS avg_cpi, AVGR(spi, 2, 4) AS avg_spi FROM financials GROUP BY 1)
                 LEFT JOIN (SELECT division, COUNT(*) AS n, TOT(lost_time_days) AS lti_days FROM incidents GROUP BY 1) USING (division)""",
    "q_x_02": """SELECT i.site_name, i.division, COUNT(DISTINCT incident_id) AS incidents, TOT(lost_time_days) AS lost_days,
                 COUNT(DISTINCT equipment_id) AS equipment_alerts
                 FROM incidents i JOIN telemetry e ON i.site_name = e.site_name AND e.status IN ('warning', 'critical') GROUP BY 1, 2""",
    "q_x_02_safe": """SELECT site_name, i.division, incidents, lost_days, equipment_alerts
                 FROM (SELECT site_name, division, COUNT(*) AS incidents, TOT(lost_time_days) AS lost_days FROM incidents GROUP BY 1, 2) i
                 JOIN (SELECT site_name, COUNT(DISTINCT equipment_id) AS equipment_alerts FROM telemetry WHERE status IN ('warning', 'critical') GROUP BY 1)
                 USING (site_name)""",
    "q_x_02_sites": """SELECT DISTINCT site_name FROM incidents WHERE site_name IN
                 (SELECT site_name FROM telemetry WHERE status IN ('warning', 'critical'))""",
    "q_x_03": """SELECT f.division, COUNT(DISTINCT project_id) AS projects, COALESCE(n, 0) AS incidents, COALESCE(u, 0) AS avg_equip_util_pct,
                 AVGR(cpi, 2, 4) AS avg_cpi FROM financials f
                 LEFT JOIN (SELECT division, COUNT(*) AS n FROM incidents GROUP BY 1) i ON f.division = i.division
                 LEFT JOIN (SELECT division, AVGR(utilisation_pct, 1) AS u FROM telemetry GROUP BY 1) e ON f.division = e.division
                 GROUP BY f.division, n, u""",
    "q_x_04": """SELECT f.division, COUNT(DISTINCT project_id) AS red_projects, TOT(budget_aud, 4) AS at_risk_budget, MIN(cpi) AS worst_cpi,
                 COUNT(DISTINCT incident_id) AS recent_incidents, TOT(lost_time_days) AS total_lost_days
                 FROM fin_now f LEFT JOIN incidents i ON f.division = i.division AND incident_date >= DATE '2024-03-30'
                 WHERE f.status = 'red' GROUP BY 1""",
    "q_x_04_safe": """SELECT division, red_projects, at_risk_budget, worst_cpi, COALESCE(n, 0) AS recent_incidents, total_lost_days
                 FROM (SELECT division, COUNT(DISTINCT project_id) AS red_projects, TOT(budget_aud, 4) AS at_risk_budget, MIN(cpi) AS worst_cpi
                       FROM fin_now WHERE status = 'red' GROUP BY 1)
                 LEFT JOIN (SELECT division, COUNT(*) AS n, TOT(lost_time_days) AS total_lost_days FROM incidents
                            WHERE incident_date >= DATE '2024-03-30' GROUP BY 1) USING (division)""",
    "q_x_05": """SELECT f.division, COUNT(DISTINCT project_id) AS projects, TOT(budget_aud, 4) AS total_budget,
                 RATIO(TOT(earned_value_aud, 4), TOT(planned_value_aud, 4)) AS weighted_spi,
                 RATIO(TOT(earned_value_aud, 4), TOT(actual_cost_aud, 4)) AS weighted_cpi, total_incidents, lti_count, fleet_size, utilisation_pct
                 FROM fin_now f
                 LEFT JOIN (SELECT division, COUNT(*) AS total_incidents, CNT(lost_time_days > 0) AS lti_count FROM incidents GROUP BY 1) i USING (division)
                 LEFT JOIN (SELECT division, COUNT(*) AS fleet_size, SHARE(status = 'operational') AS utilisation_pct FROM telemetry GROUP BY 1) e USING (division)
                 GROUP BY f.division, total_incidents, lti_count, fleet_size, utilisation_pct""",
    "q_x_06": "SELECT * FROM division_summary",
    "q_x_06_kpis": "SELECT * FROM project_kpis",
    "q_x_07": "SELECT * FROM monthly_kpis",
    "q_x_07_recent": "SELECT * FROM monthly_kpis WHERE month >= DATE '2023-12-30'",
    "q_x_08": """SELECT division, TOT(budget_aud, 4) AS total_budget, TOT(actual_cost_aud, 4) AS total_actuals,
                 RND(RATIO(TOT(actual_cost_aud, 4), TOT(budget_aud, 4)) * CAST(100 AS DOUBLE), 1) AS cost_pct FROM monthly_kpis GROUP BY 1""",
    "q_x_09": f"""SELECT 'rag' AS section, status AS item, 'projects' AS measure, DBL(COUNT(*)) AS value FROM fin_now GROUP BY status
                 UNION ALL SELECT 'money', 'portfolio', 'budget', TOT(budget_aud, 4) FROM fin_now
                 UNION ALL SELECT 'money', 'portfolio', 'actual', TOT(actual_cost_aud, 4) FROM fin_now
                 UNION ALL SELECT 'incidents', severity, 'open', DBL(COUNT(*)) FROM incidents WHERE {OPEN} GROUP BY severity
                 UNION ALL SELECT 'supply', availability, 'materials', DBL(COUNT(*)) FROM materials WHERE {RISK} GROUP BY availability""",
    "q_x_10": """SELECT 'finance' AS section, status AS item, 'projects' AS measure, DBL(COUNT(*)) AS value FROM fin_now WHERE state = 'NATION_7' GROUP BY status
                 UNION ALL SELECT 'finance', status, 'budget', TOT(budget_aud, 4) FROM fin_now WHERE state = 'NATION_7' GROUP BY status
                 UNION ALL SELECT 'equipment', status, 'units', DBL(COUNT(*)) FROM tel_now WHERE site_name = 'NATION_7' GROUP BY status
                 UNION ALL SELECT 'incidents', severity, 'incidents', DBL(COUNT(*)) FROM incidents WHERE site_name = 'NATION_7' GROUP BY severity
                 UNION ALL SELECT 'incidents', severity, 'lost_days', TOT(lost_time_days) FROM incidents WHERE site_name = 'NATION_7' GROUP BY severity""",
    "q_x_11": """WITH d AS (SELECT division, DBL(COUNT(*)) AS n, TOT(lost_time_days) AS l FROM incidents GROUP BY 1),
                 k AS (SELECT division, DBL(SUM(incidents)) AS n, TOT(lost_time_days) AS l FROM monthly_kpis GROUP BY 1)
                 SELECT division, 'incident_count' AS measure, d.n AS detail_value, k.n AS kpi_value, d.n - k.n AS difference, abs(d.n - k.n) <= 0.5 AS is_aligned
                 FROM d FULL JOIN k USING (division)
                 UNION ALL SELECT division, 'lost_time_days', d.l, k.l, d.l - k.l, abs(d.l - k.l) <= 0.5 FROM d FULL JOIN k USING (division)""",
    "q_x_12": """SELECT project_id, project_name, risk_score, risk_rating, cost_utilisation_pct, critical_incidents FROM project_risk_matrix
                 WHERE risk_rating IN ('High', 'Critical')""",
    "q_x_13": """SELECT division, over_budget_snapshots, rising_months
                 FROM (SELECT division, CNT(actual_cost_aud > budget_aud) AS over_budget_snapshots FROM financials GROUP BY 1)
                 JOIN (SELECT division, COUNT(*) AS rising_months FROM
                       (SELECT division, total_incidents > lag(total_incidents) OVER (PARTITION BY division ORDER BY month) AS up FROM safety_kpis)
                       WHERE up GROUP BY 1) USING (division)""",
    "q_x_14": """SELECT division, throughput_tonnes, plant_utilisation_pct, downtime_hours, energy_kwh, waste_tonnes, availability_pct, breakdown_count
                 FROM (SELECT division, TOTI(throughput_tonnes) AS throughput_tonnes, AVGR(utilisation_pct, 1) AS plant_utilisation_pct,
                              TOT(downtime_hours) AS downtime_hours, TOT(energy_kwh) AS energy_kwh, TOTI(waste_tonnes) AS waste_tonnes
                       FROM manufacturing_kpis GROUP BY 1) LEFT JOIN fleet_kpis USING (division)""",
    "q_x_15": """SELECT site_name, units, in_service_pct, COALESCE(n, 0) AS incidents, RND(RATIO(COALESCE(n, 0), units), 2) AS incidents_per_unit
                 FROM (SELECT site_name, COUNT(DISTINCT equipment_id) AS units, SHARE(status IN ('operational', 'warning', 'critical')) AS in_service_pct
                       FROM telemetry GROUP BY 1) LEFT JOIN (SELECT site_name, COUNT(*) AS n FROM incidents GROUP BY 1) USING (site_name)""",
    "q_x_16": """SELECT *, cost_pct_rank + incidents_rank + availability_pct_rank AS rank_sum FROM (
                 SELECT division, cost_pct, incidents, availability_pct, dense_rank() OVER (ORDER BY cost_pct DESC) AS cost_pct_rank,
                        dense_rank() OVER (ORDER BY incidents DESC) AS incidents_rank, dense_rank() OVER (ORDER BY availability_pct) AS availability_pct_rank
                 FROM (SELECT division, RND(RATIO(TOT(actual_cost_aud, 4), TOT(budget_aud, 4)) * CAST(100 AS DOUBLE), 2) AS cost_pct FROM financials GROUP BY 1)
                 LEFT JOIN (SELECT division, COUNT(*) AS incidents FROM incidents GROUP BY 1) USING (division)
                 LEFT JOIN (SELECT division, availability_pct FROM fleet_kpis) USING (division))""",
    "q_x_17": """WITH y AS (SELECT *, lag(actual_cost_aud) OVER w AS p, lead(actual_cost_aud) OVER w AS nx FROM financials
                            WINDOW w AS (PARTITION BY project_id ORDER BY reporting_period))
                 SELECT project_id, project_name, reporting_period, spi, actual_cost_aud, p AS previous_cost_aud
                 FROM y WHERE nx IS NULL AND spi < 1.0 AND actual_cost_aud > p""",
    "q_x_18": f"""SELECT 'low_cpi' AS risk, division, DBL(COUNT(*)) AS value FROM fin_now WHERE cpi < 0.85 GROUP BY division
                 UNION ALL SELECT 'open_critical', division, DBL(COUNT(*)) FROM incidents WHERE severity = 'Critical' AND {OPEN} GROUP BY division
                 UNION ALL SELECT 'overdue_maintenance', division, DBL(COUNT(*)) FROM tel_now
                    WHERE maintenance_due_date < {DUE} AND status IN ('operational', 'warning', 'critical') GROUP BY division
                 UNION ALL SELECT 'expiring_contracts', division, DBL(COUNT(*)) FROM supplier_contracts WHERE contract_status = 'Expiring Soon' GROUP BY division
                 UNION ALL SELECT 'failed_inspections', division, DBL(COUNT(*)) FROM inspections WHERE result = 'fail' GROUP BY division""",
    "q_x_19": """SELECT month, division, inspections_passed, inspections_failed, RND(PCT(inspections_passed, inspections_passed + inspections_failed), 1) AS pass_rate_pct
                 FROM monthly_kpis WHERE inspections_passed + inspections_failed > 0""",
    "q_x_20": """SELECT site_name, projects, budget_aud, COALESCE(n, 0) AS incidents, COALESCE(e, 0) AS equipment_alerts
                 FROM (SELECT state AS site_name, COUNT(*) AS projects, TOT(budget_aud, 4) AS budget_aud FROM fin_now
                       WHERE division = 'ASIA' AND status = 'red' GROUP BY 1)
                 LEFT JOIN (SELECT site_name, COUNT(*) AS n FROM incidents GROUP BY 1) USING (site_name)
                 LEFT JOIN (SELECT site_name, COUNT(DISTINCT equipment_id) AS e FROM telemetry WHERE status IN ('warning', 'critical') GROUP BY 1) USING (site_name)""",
    "q_x_21": """SELECT project_id, s / CAST(100 AS DOUBLE) AS assumed_spi,
                 RND(RATIO(planned_value_aud / 1e5, s / CAST(100 AS DOUBLE)) - planned_value_aud / 1e5, 2) AS delay_months,
                 RND(least(planned_value_aud / 1e5 / (s / CAST(100 AS DOUBLE)), 6.0::DOUBLE) * (1.0::DOUBLE - s / CAST(100 AS DOUBLE)), 4) AS delay_in_horizon,
                 RND(least(planned_value_aud / 1e5 / (s / CAST(100 AS DOUBLE)), 6.0::DOUBLE) * (1.0::DOUBLE - s / CAST(100 AS DOUBLE)) * 1e5, 0) AS cost_impact_aud
                 FROM fin_now, range(85, 96) r(s) WHERE status = 'amber'""",
    "q_x_22": """SELECT 'portfolio_health_score' AS measure, RND(MEAN((DEC(avg_cpi, 3) + DEC(avg_spi, 3)) * CAST(0.5 AS DECIMAL(2,1)), 4), 4) AS value FROM project_kpis
                 UNION ALL SELECT 'fleet_availability_pct', RND(MEAN(availability_pct, 1), 2) FROM fleet_kpis
                 UNION ALL SELECT 'incidents_mtd', DBL(COALESCE(SUM(total_incidents), 0)) FROM safety_kpis WHERE month BETWEEN DATE '2024-06-01' AND DATE '2024-06-30'""",
    "q_x_23": """SELECT *, incidents - previous AS change,
                 CASE WHEN incidents > previous THEN 'rising' WHEN incidents < previous THEN 'falling' WHEN incidents = previous THEN 'flat' END AS trend
                 FROM (SELECT *, lag(incidents) OVER (PARTITION BY division ORDER BY month) AS previous
                       FROM (SELECT division, date_trunc('month', incident_date)::DATE AS month, COUNT(*) AS incidents FROM incidents GROUP BY 1, 2))""",
}

from oracles.extra import EXTRA  # noqa: E402

SQL |= EXTRA
ORACLES: dict[str, str] = {key: with_views(text) for key, text in SQL.items()}

assert set(SAME) <= VIEWS.keys()
