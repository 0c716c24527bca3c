"""The derived tables as SQL views, and a helper that prepends the ones a query needs."""

from __future__ import annotations

import re

from oracles.macros import expand

VIEWS: dict[str, str] = {
    "sites": """
        SELECT n_nationkey, n_name AS site_name, r_name AS division
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "ev": """
        SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS k,
               site_name, division
        FROM events JOIN sites ON user_id % 25 = n_nationkey""",
    "supplier_sites": """
        SELECT s_suppkey, s_name, s_nationkey, site_name, division
        FROM supplier JOIN sites ON s_nationkey = n_nationkey""",
    "customer_sites": """
        SELECT c_custkey, c_name, c_mktsegment, site_name, division
        FROM customer JOIN sites ON c_nationkey = n_nationkey""",
    "bronze_gps_pings": """
        SELECT CAST(event_id AS VARCHAR) AS ping_id, 'V-' || user_id AS vehicle_id,
               ['haul_truck','excavator','loader','crane'][user_id % 4 + 1] AS vehicle_type,
               site_name, CAST(-5.0 AS DOUBLE) - k * CAST(0.5 AS DOUBLE) AS latitude,
               CAST(105.0 AS DOUBLE) + event_id % 60 AS longitude,
               value - CAST(5.0 AS DOUBLE) AS speed_kmh, DBL(event_id % 360) AS heading_degrees,
               event_type <> 'signup' AS engine_on, DBL(k) AS fuel_level_pct, ts AS ping_timestamp,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id
        FROM ev""",
    "bronze_delivery_receipts": """
        SELECT l_orderkey || '-' || l_linenumber AS delivery_id, s_name AS supplier, p_type AS material,
               CAST(l_quantity AS INT) AS quantity, p_retailprice AS unit_price,
               DBL(DEC(p_retailprice) * CAST(l_quantity AS DECIMAL(10,0))
                   * CAST(CASE WHEN l_tax > CAST(0.075 AS DOUBLE) THEN 1.05 ELSE 1.00 END AS DECIMAL(3,2))) AS total_cost,
               site_name AS destination_site, CAST(l_orderkey AS VARCHAR) AS po_number,
               CAST(l_shipdate AS DATE) AS delivery_date,
               CASE WHEN l_returnflag = 'N' THEN 'good'
                    WHEN l_returnflag = 'A' AND l_linestatus <> 'O' THEN 'partial'
                    WHEN l_returnflag = 'A' THEN 'good'
                    WHEN l_returnflag = 'R' AND l_linestatus <> 'O' THEN 'damaged' END AS condition,
               l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer_sites ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey""",
    "silver_deliveries": """
        SELECT delivery_id, supplier, material, quantity, unit_price, total_cost, destination_site, po_number,
               delivery_date, cost_variance_pct, cost_variance_pct < 1.0 AS cost_validated,
               COALESCE(condition, 'unknown') AS condition,
               COALESCE(condition, 'unknown') IN ('damaged', 'partial') AS is_damaged
        FROM (SELECT *, CASE WHEN quantity * unit_price > 0
                             THEN abs(total_cost - quantity * unit_price) / (quantity * unit_price) * 100
                             ELSE CAST(0 AS DOUBLE) END AS cost_variance_pct,
                     row_number() OVER (PARTITION BY delivery_id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                        l_extendedprice DESC, l_discount DESC, l_tax DESC, quantity DESC) AS rn
              FROM bronze_delivery_receipts)
        WHERE rn = 1""",
    "silver_fleet_positions": """
        SELECT ping_id, vehicle_id, vehicle_type, site_name, latitude, longitude, speed_kmh, heading_degrees, engine_on,
               fuel_level_pct, ping_timestamp, batch_id, speed_kmh > 1.0 AS is_moving,
               engine_on AND speed_kmh <= 1.0 AS is_idling
        FROM (SELECT * REPLACE (CASE WHEN speed_kmh < 0 THEN CAST(0 AS DOUBLE) WHEN speed_kmh > 120 THEN CAST(120 AS DOUBLE)
                                     ELSE speed_kmh END AS speed_kmh)
              FROM bronze_gps_pings
              WHERE latitude BETWEEN -45 AND -10 AND longitude BETWEEN 110 AND 155)""",
    "silver_inventory": """
        SELECT 'WH-' || s_nationkey AS warehouse_id, site_name || ' Depot' AS warehouse_name, division AS region,
               p_type AS material, CAST(greatest(q % 1500 - 50, 0) AS INT) AS on_hand_qty,
               CAST(100 + n % 400 AS INT) AS reorder_point, q % 1500 - 50 < 100 + n % 400 AS below_reorder,
               d AS last_replenished, CAST(d AS TIMESTAMP) AS snapshot_timestamp, CAST(yr AS VARCHAR) AS batch_id,
               CASE WHEN q % 1500 - 50 <= 0 THEN 'out_of_stock'
                    WHEN q % 1500 - 50 < 100 + n % 400 THEN 'below_reorder'
                    WHEN q % 1500 - 50 > 3 * (100 + n % 400) THEN 'overstocked'
                    ELSE 'healthy' END AS stock_status,
               CAST(date_diff('day', d, DATE '2001-07-01') AS INT) AS days_since_replenishment
        FROM (SELECT s_nationkey, site_name, division, p_type, year(l_shipdate) AS yr,
                     CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q, COUNT(*) AS n,
                     MAX(CAST(l_shipdate AS DATE)) AS d
              FROM lineitem JOIN supplier_sites ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
              GROUP BY ALL)""",
    "silver_invoices": """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, s_name AS supplier, CAST(o_orderkey AS VARCHAR) AS po_number,
               d AS invoice_date, d + 30 AS due_date, CAST(n AS INT) AS line_items, o_totalprice AS subtotal_aud,
               DBL(gst) AS gst_aud, DBL(DEC(o_totalprice) + gst) AS total_aud, payment_status, site_name AS site,
               abs(DBL(gst) - o_totalprice * CAST(0.1 AS DOUBLE)) < 1.0 AS gst_validated,
               payment_status = 'pending' AND d + 30 < DATE '2001-07-01' AS is_overdue,
               CAST(date_diff('day', DATE '2001-07-01', d + 30) AS INT) AS days_until_due
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS d,
                     DEC(o_totalprice) * CAST(0.1 AS DECIMAL(2,1))
                        + CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 5 ELSE 0 END AS DECIMAL(3,0)) AS gst,
                     CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'pending'
                          WHEN o_orderpriority = '5-LOW' THEN 'disputed' ELSE 'approved' END AS payment_status
              FROM orders
              JOIN (SELECT l_orderkey, MIN(l_suppkey) AS sk, COUNT(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
              JOIN supplier ON sk = s_suppkey
              JOIN customer_sites ON o_custkey = c_custkey)""",
    "financials": """
        SELECT CAST(o_custkey AS VARCHAR) AS project_id, c_name AS project_name, division,
               'Client ' || c_mktsegment AS client, c_mktsegment AS project_type, site_name AS state,
               budget_aud, actual_cost_aud, earned_value_aud, planned_value_aud,
               RND(RATIO(earned_value_aud - actual_cost_aud, earned_value_aud) * CAST(100.0 AS DOUBLE), 2) AS cost_variance_pct,
               RND(RATIO(earned_value_aud - planned_value_aud, planned_value_aud) * CAST(100.0 AS DOUBLE), 2) AS schedule_variance_pct,
               spi, cpi,
               CASE WHEN least(spi, cpi) < 0.95 THEN 'red' WHEN least(spi, cpi) < 1.0 THEN 'amber' ELSE 'green' END AS status,
               start_date, planned_completion, make_date(yr, 1, 1) AS reporting_period,
               'PM-' || (o_custkey % 20) AS project_manager,
               RND(RATIO(earned_value_aud, budget_aud) * CAST(100.0 AS DOUBLE), 1) AS pct_complete
        FROM (SELECT *, RND(RATIO(earned_value_aud, planned_value_aud), 4) AS spi,
                        RND(RATIO(earned_value_aud, actual_cost_aud), 4) AS cpi
              FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS yr,
                           DBL(SUM(DEC(l_extendedprice) * CAST(0.96 AS DECIMAL(3,2)))) AS budget_aud,
                           DBL(SUM(DEC(l_extendedprice) * (CAST(0.91 AS DECIMAL(3,2)) + CAST(l_tax AS DECIMAL(4,2))))) AS actual_cost_aud,
                           DBL(SUM(DEC(l_extendedprice) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(4,2))))) AS earned_value_aud,
                           DBL(SUM(DEC(l_extendedprice) * CAST(0.95 AS DECIMAL(3,2)))) AS planned_value_aud,
                           MIN(CAST(o_orderdate AS DATE)) AS start_date, MAX(CAST(o_orderdate AS DATE)) + 400 AS planned_completion
                    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2))
        JOIN customer_sites ON o_custkey = c_custkey""",
    "fin_now": "SELECT * FROM financials WHERE reporting_period = (SELECT MAX(reporting_period) FROM financials)",
    "milestones": """
        SELECT 'M-' || o_orderkey AS milestone_id, CAST(o_custkey AS VARCHAR) AS project_id,
               CAST(o_orderdate AS DATE) AS planned_date, a AS actual_date,
               ['design','construction','handover'][o_orderkey % 3 + 1] AS milestone_type,
               o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_critical_path,
               date_diff('day', CAST(o_orderdate AS DATE) + 45, a) AS delay_days,
               CASE WHEN date_diff('day', CAST(o_orderdate AS DATE) + 45, a) > 30 THEN 'delayed'
                    WHEN date_diff('day', CAST(o_orderdate AS DATE) + 45, a) > 0 THEN 'at_risk' ELSE 'on_track' END AS status
        FROM orders JOIN (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS a FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "inspections": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS inspection_id,
               CAST(o_custkey AS VARCHAR) AS project_id, site_name, division,
               ['weld_test','concrete_test','survey'][l_linenumber % 3 + 1] AS inspection_type,
               ['structural','civil','electrical'][l_partkey % 3 + 1] AS discipline,
               CASE l_returnflag WHEN 'R' THEN 'fail' WHEN 'A' THEN 'conditional' ELSE 'pass' END AS result,
               CASE WHEN l_returnflag = 'R' THEN ['crack','void','alignment','finish'][l_partkey % 4 + 1] END AS defect_category,
               CASE WHEN l_returnflag = 'R' THEN ['Critical','Serious','Moderate','Minor'][l_suppkey % 4 + 1] END AS severity,
               CASE WHEN l_returnflag = 'R' THEN DBL(DEC(l_extendedprice) * CAST(l_discount AS DECIMAL(4,2))) END AS rework_cost_aud,
               'INSP-' || (l_suppkey % 15) AS inspector, CAST(l_shipdate AS DATE) AS inspection_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier_sites ON l_suppkey = s_suppkey""",
    "telemetry": """
        SELECT 'EQ-' || user_id AS equipment_id,
               ['haul_truck','excavator','drill','loader','dozer','grader','water_cart','crane'][user_id % 8 + 1] AS equipment_type,
               ['Maker A','Maker B','Maker C','Maker D','Maker E'][user_id % 5 + 1] AS manufacturer, site_name, division,
               CAST(70 AS DOUBLE) + value * CAST(0.5 AS DOUBLE) AS engine_temp_celsius, DBL(k) AS fuel_level_pct,
               CAST(100 AS DOUBLE) + k * CAST(3.5 AS DOUBLE) AS hydraulic_pressure_bar,
               CAST(20 AS DOUBLE) + value * CAST(0.1 AS DOUBLE) AS fuel_consumption_lph,
               CAST(100 AS DOUBLE) - k AS utilisation_pct, CAST(user_id * 131 % 20000 AS INT) AS operating_hours,
               CAST(ts AS DATE) + (k - 50) AS maintenance_due_date,
               CASE event_type WHEN 'error' THEN 'critical' WHEN 'signup' THEN 'warning' WHEN 'purchase' THEN 'maintenance'
                    ELSE 'operational' END AS status,
               ts AS reading_timestamp
        FROM ev""",
    "tel_now": """
        SELECT t.* FROM telemetry t
        JOIN (SELECT equipment_id, MAX(reading_timestamp) AS m FROM telemetry GROUP BY 1) x
          ON t.equipment_id = x.equipment_id AND t.reading_timestamp = x.m""",
    "incidents": """
        SELECT *, injuries = 0 AND lost_time_days = 0 AS is_near_miss, incident_type || ' at ' || site_name AS description,
               'review ' || root_cause AS corrective_action
        FROM (SELECT 'INC-' || event_id AS incident_id, CAST(ts AS DATE) + CAST(event_id % 180 AS INT) AS incident_date,
                     site_name, division,
                     ['Slip/Trip/Fall','Vehicle Interaction','Equipment Failure','Falling Object','Chemical Exposure','Heat Stress',
                      'Noise Exposure','Confined Space','Electrical','Struck By','Near Miss','Working at Height'][event_id % 12 + 1] AS incident_type,
                     CASE WHEN k < 7 THEN 'Critical' WHEN k < 25 THEN 'Serious' WHEN k < 55 THEN 'Moderate' ELSE 'Minor' END AS severity,
                     CAST(CASE WHEN k >= 55 THEN 0 ELSE k % 4 END AS INT) AS injuries,
                     CASE WHEN k >= 55 THEN CAST(0 AS DOUBLE) ELSE floor(value * CAST(0.1 AS DOUBLE)) END AS lost_time_days,
                     ['human_error','equipment_failure','procedural','environmental','design','poor_housekeeping',
                      'inadequate_training'][event_id % 7 + 1] AS root_cause,
                     ['open','investigating','closed'][event_id % 3 + 1] AS status, ['day','night'][event_id % 2 + 1] AS shift
              FROM ev WHERE event_type IN ('error', 'signup'))""",
    "maintenance_log": """
        SELECT 'WO-' || event_id AS work_order_id, 'EQ-' || user_id AS equipment_id,
               ['scheduled','unscheduled','breakdown','inspection'][event_id % 4 + 1] AS maintenance_type,
               'work order ' || event_id AS description, k * CAST(0.5 AS DOUBLE) AS downtime_hours,
               DBL(DEC(value) * 100) AS cost_aud, DBL(DEC(value) * 60) AS parts_cost_aud, DBL(DEC(value) * 40) AS labour_cost_aud,
               CASE WHEN k < 90 THEN 'completed' ELSE 'open' END AS status, site_name, division, CAST(ts AS DATE) AS work_date
        FROM ev WHERE event_type = 'purchase'""",
    "timesheets": """
        SELECT 'TS-' || event_id AS timesheet_id, 'E-' || user_id AS employee_id, CAST(user_id AS VARCHAR) AS project_id,
               ['operator','engineer','supervisor','labourer'][user_id % 4 + 1] AS role, site_name, division,
               CAST(7.6 AS DOUBLE) AS hours_regular, DBL(ot) AS hours_overtime, DBL(w) AS hourly_rate_aud,
               DBL(CAST(7.6 AS DECIMAL(4,2)) * w + ot * w * CAST(1.5 AS DECIMAL(4,2)) + CASE WHEN event_id % 50 = 0 THEN 10 ELSE 0 END) AS total_cost_aud,
               k % 10 <> 0 AS is_inducted, CAST(ts AS DATE) AS work_date
        FROM (SELECT *, CAST(CASE WHEN k >= 80 THEN k - 80 ELSE 0 END AS DECIMAL(4,0)) * CAST(0.25 AS DECIMAL(4,2)) AS ot,
                     CAST(40 + user_id % 30 AS DECIMAL(4,0)) AS w
              FROM ev WHERE event_type IN ('view', 'click'))""",
    "emissions": """
        SELECT 'R-' || event_id AS reading_id, site_name, division,
               ['dust_pm10','dust_pm2_5','noise_db','water_ph'][event_id % 4 + 1] AS monitor_type,
               ['ug/m3','ug/m3','dB','pH'][event_id % 4 + 1] AS unit, value AS measurement_value,
               CAST(100 AS DOUBLE) AS threshold_value, value > 100 AS is_exceedance,
               ['none','water_cart','stop_work'][k % 3 + 1] AS action_taken, CAST(ts AS DATE) AS reading_date,
               lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || ':00' AS reading_time
        FROM ev""",
    "materials": """
        SELECT l_partkey || '-' || l_suppkey AS material_id, p_name AS material_name, p_type AS category, s_name AS supplier,
               p_retailprice AS unit_price_aud, 'unit' AS unit, p_size AS lead_time_days, CAST(l_shipdate AS DATE) AS last_order_date,
               l_quantity AS last_order_qty,
               CASE l_partkey % 4 WHEN 0 THEN 'increasing' WHEN 3 THEN 'decreasing' ELSE 'stable' END AS price_trend,
               CASE WHEN l_partkey % 20 = 0 THEN 'out_of_stock' WHEN l_partkey % 20 < 4 THEN 'limited'
                    WHEN l_partkey % 20 < 9 THEN 'moderate' ELSE 'good' END AS availability,
               DEC(p_retailprice) * CAST(l_quantity AS DECIMAL(10,0)) AS spend,
               DBL(DEC(p_retailprice) * CAST(l_quantity AS DECIMAL(10,0))) AS total_cost_aud, site_name, division, l_orderkey
        FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                        l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS rn FROM lineitem)
        JOIN part ON l_partkey = p_partkey JOIN supplier_sites ON l_suppkey = s_suppkey
        WHERE rn = 1""",
    "project_materials": """
        SELECT m.*, CAST(o_custkey AS VARCHAR) AS project_id FROM materials m JOIN orders ON l_orderkey = o_orderkey""",
    "manufacturing_kpis": """
        SELECT date_trunc('month', l_shipdate)::DATE AS month, division, TOTI(CAST(l_quantity AS BIGINT)) AS throughput_tonnes,
               CAST(60 AS DOUBLE) + COUNT(*) % 40 AS utilisation_pct, CNT(l_returnflag = 'R') * CAST(0.5 AS DOUBLE) AS downtime_hours,
               TOTI(CAST(l_quantity AS BIGINT)) * CAST(2.5 AS DOUBLE) AS energy_kwh, CNT(l_returnflag = 'R') AS waste_tonnes
        FROM lineitem JOIN supplier_sites ON l_suppkey = s_suppkey GROUP BY 1, 2""",
    "supplier_contracts": """
        SELECT s_name AS supplier_name, division,
               CASE s_suppkey % 5 WHEN 0 THEN 'Expiring Soon' WHEN 1 THEN 'Under Review' ELSE 'Active' END AS contract_status
        FROM supplier_sites""",
    # --- products
    "gold_fleet_utilisation_daily": """
        SELECT CAST(ping_timestamp AS DATE) AS report_date, vehicle_id, vehicle_type, site_name, COUNT(*) AS total_pings,
               CNT(is_moving) AS moving_pings, CNT(is_idling) AS idling_pings, CNT(NOT engine_on) AS off_pings,
               AVGR(speed_kmh, 1) AS avg_speed_kmh, RND(MAX(speed_kmh), 1) AS max_speed_kmh,
               AVGR(fuel_level_pct, 1) AS avg_fuel_pct, RND(MIN(fuel_level_pct), 1) AS min_fuel_pct,
               SHARE(is_moving) AS utilisation_pct, SHARE(is_idling) AS idle_pct
        FROM silver_fleet_positions GROUP BY 1, 2, 3, 4""",
    "gold_delivery_performance": """
        SELECT supplier, destination_site, COUNT(*) AS total_deliveries, TOT(total_cost, 4) AS total_spend_aud,
               AVGR(total_cost, 2, 4) AS avg_delivery_cost_aud, CNT(is_damaged) AS damaged_deliveries,
               SHARE(is_damaged) AS damage_rate_pct, CNT(NOT cost_validated) AS cost_discrepancies,
               COUNT(DISTINCT material) AS unique_materials, COUNT(DISTINCT po_number) AS unique_pos
        FROM silver_deliveries GROUP BY 1, 2""",
    "gold_inventory_health": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY warehouse_id, material ORDER BY snapshot_timestamp DESC, batch_id DESC) AS rn
            FROM silver_inventory) WHERE rn = 1""",
    "gold_invoice_aging": """
        SELECT invoice_id, supplier, site, invoice_date, due_date, total_aud, payment_status, days_until_due, is_overdue,
               CASE WHEN payment_status IN ('paid', 'approved') THEN 'settled'
                    WHEN days_until_due > 30 THEN 'not_yet_due' WHEN days_until_due >= 15 THEN 'due_soon'
                    WHEN days_until_due >= 0 THEN 'due_imminent' WHEN days_until_due >= -30 THEN 'overdue_30'
                    WHEN days_until_due >= -60 THEN 'overdue_60' ELSE 'overdue_90_plus' END AS aging_bucket,
               CASE WHEN payment_status = 'disputed' OR (is_overdue AND days_until_due < -30) THEN 'high'
                    WHEN is_overdue OR days_until_due < 7 THEN 'medium' ELSE 'low' END AS payment_risk
        FROM silver_invoices""",
    "gold_site_operations_summary": """
        SELECT site_name, active_vehicles, fleet_utilisation_pct, avg_fuel_level, total_deliveries, delivery_spend_aud,
               damaged_count, active_suppliers, total_invoiced_aud, overdue_amount_aud, disputed_invoices
        FROM (SELECT site_name, COUNT(DISTINCT vehicle_id) AS active_vehicles, SHARE(is_moving) AS fleet_utilisation_pct,
                     AVGR(fuel_level_pct, 1) AS avg_fuel_level FROM silver_fleet_positions GROUP BY 1)
        FULL JOIN (SELECT destination_site AS site_name, COUNT(*) AS total_deliveries, TOT(total_cost, 4) AS delivery_spend_aud,
                          CNT(is_damaged) AS damaged_count, COUNT(DISTINCT supplier) AS active_suppliers
                   FROM silver_deliveries GROUP BY 1) USING (site_name)
        FULL JOIN (SELECT site AS site_name, TOT(total_aud, 3) AS total_invoiced_aud,
                          TOT(CASE WHEN is_overdue THEN total_aud ELSE 0 END, 3) AS overdue_amount_aud,
                          CNT(payment_status = 'disputed') AS disputed_invoices
                   FROM silver_invoices GROUP BY 1) USING (site_name)""",
    "gold_supplier_scorecard": """
        SELECT supplier, deliveries, delivery_spend_aud, delivery_damage_rate_pct, cost_discrepancy_rate_pct, sites_served,
               invoices, invoiced_aud, disputed_invoices, invoice_overdue_pct, RND(s, 1) AS supplier_score,
               CASE WHEN s >= 90 THEN 'A - Preferred' WHEN s >= 75 THEN 'B - Approved' WHEN s >= 50 THEN 'C - Conditional'
                    ELSE 'D - Review Required' END AS supplier_tier
        FROM (SELECT *, CAST(100 AS DOUBLE) - COALESCE(delivery_damage_rate_pct, 0) * CAST(2 AS DOUBLE)
                        - COALESCE(cost_discrepancy_rate_pct, 0) * CAST(1.5 AS DOUBLE) - COALESCE(invoice_overdue_pct, 0)
                        - COALESCE(DBL(disputed_invoices), 0) * CAST(5 AS DOUBLE) AS s
              FROM (SELECT supplier, COUNT(*) AS deliveries, TOT(total_cost, 4) AS delivery_spend_aud,
                           SHARE(is_damaged) AS delivery_damage_rate_pct, SHARE(NOT cost_validated) AS cost_discrepancy_rate_pct,
                           COUNT(DISTINCT destination_site) AS sites_served FROM silver_deliveries GROUP BY 1)
              FULL JOIN (SELECT supplier, COUNT(*) AS invoices, TOT(total_aud, 3) AS invoiced_aud,
                                CNT(payment_status = 'disputed') AS disputed_invoices, SHARE(is_overdue) AS invoice_overdue_pct
                         FROM silver_invoices GROUP BY 1) USING (supplier))""",
    "project_kpis": """
        SELECT division, TOT(budget_aud, 4) AS total_budget, TOT(actual_cost_aud, 4) AS total_actual_cost,
               AVGR(cpi, 3, 4) AS avg_cpi, AVGR(spi, 3, 4) AS avg_spi, COUNT(*) AS project_count, CNT(status = 'red') AS red_projects
        FROM fin_now GROUP BY 1""",
    "safety_kpis": """
        SELECT division, date_trunc('month', incident_date)::DATE AS month, COUNT(*) AS total_incidents,
               CNT(is_near_miss) AS near_misses, CNT(lost_time_days > 0) AS ltis, TOT(lost_time_days) AS lost_time_days
        FROM incidents GROUP BY 1, 2""",
    "fleet_kpis": """
        SELECT division, total_equipment, operational_count, RND(PCT(operational_count, total_equipment), 1) AS availability_pct,
               COALESCE(c, 0) AS total_maintenance_cost, COALESCE(b, 0) AS breakdown_count
        FROM (SELECT division, COUNT(DISTINCT equipment_id) AS total_equipment, CNT(status = 'operational') AS operational_count
              FROM tel_now GROUP BY 1)
        LEFT JOIN (SELECT division, TOT(cost_aud) AS c, CNT(maintenance_type = 'breakdown') AS b FROM maintenance_log GROUP BY 1)
        USING (division)""",
    "division_summary": """
        SELECT p.*, COALESCE(f.total_equipment, 0) AS fleet_count, f.availability_pct AS fleet_operational_pct,
               COALESCE(i.n, 0) AS incident_count, COALESCE(e.n, 0) AS exceedance_count
        FROM project_kpis p LEFT JOIN fleet_kpis f USING (division)
        LEFT JOIN (SELECT division, COUNT(*) AS n FROM incidents GROUP BY 1) i USING (division)
        LEFT JOIN (SELECT division, CNT(is_exceedance) AS n FROM emissions GROUP BY 1) e USING (division)""",
    "monthly_kpis": """
        SELECT division, month, COALESCE(budget_aud, 0) AS budget_aud, COALESCE(actual_cost_aud, 0) AS actual_cost_aud,
               COALESCE(total_incidents, 0) AS incidents, COALESCE(near_misses, 0) AS near_misses,
               COALESCE(lost_time_days, 0) AS lost_time_days, COALESCE(p, 0) AS inspections_passed,
               COALESCE(f, 0) AS inspections_failed, COALESCE(x, 0) AS exceedances
        FROM (SELECT division, date_trunc('month', reporting_period)::DATE AS month, TOT(budget_aud, 4) AS budget_aud,
                     TOT(actual_cost_aud, 4) AS actual_cost_aud FROM financials GROUP BY 1, 2)
        FULL JOIN safety_kpis USING (division, month)
        FULL JOIN (SELECT division, date_trunc('month', inspection_date)::DATE AS month, CNT(result = 'pass') AS p,
                          CNT(result = 'fail') AS f FROM inspections GROUP BY 1, 2) USING (division, month)
        FULL JOIN (SELECT division, date_trunc('month', reading_date)::DATE AS month, CNT(is_exceedance) AS x
                   FROM emissions GROUP BY 1, 2) USING (division, month)""",
    "exec_scorecard": """
        SELECT supplier_name, division, category, total_spend_aud, on_time_delivery_pct, quality_score, contract_status, last_review_date
        FROM (SELECT s_name AS supplier_name, p_type AS category, TOT(l_extendedprice) AS total_spend_aud,
                     SHARE(CAST(l_shipdate AS DATE) <= CAST(o_orderdate AS DATE) + 45) AS on_time_delivery_pct,
                     greatest(CAST(1 AS DOUBLE), RND(CAST(5 AS DOUBLE) - RATIO(CNT(l_returnflag = 'R'), COUNT(*)) * CAST(6 AS DOUBLE), 2)) AS quality_score,
                     MAX(CAST(l_shipdate AS DATE)) AS last_review_date
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
              JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        LEFT JOIN supplier_contracts USING (supplier_name)""",
    "project_risk_matrix": """
        SELECT project_id, project_name, division, risk_score,
               CASE WHEN risk_score >= 50 THEN 'Critical' WHEN risk_score >= 35 THEN 'High' WHEN risk_score >= 20 THEN 'Medium'
                    ELSE 'Low' END AS risk_rating, cost_utilisation_pct, critical_incidents
        FROM (SELECT f.project_id, project_name, division, RND(PCT(actual_cost_aud, budget_aud), 1) AS cost_utilisation_pct,
                     COALESCE(h.crit, 0) AS critical_incidents,
                     RND(COALESCE(least(greatest((CAST(1 AS DOUBLE) - cpi) * CAST(400 AS DOUBLE), CAST(0 AS DOUBLE)), CAST(40 AS DOUBLE)), 0)
                         + COALESCE(RATIO(ms.late, ms.n), 0) * CAST(30 AS DOUBLE)
                         + least(COALESCE(RATIO(h.crit, h.n), 0) * CAST(100 AS DOUBLE), CAST(20 AS DOUBLE))
                         + COALESCE(RATIO(sp.bad, sp.n), 0) * CAST(10 AS DOUBLE), 1) AS risk_score
              FROM financials f
              JOIN (SELECT project_id, MAX(reporting_period) AS m FROM financials GROUP BY 1) x
                ON f.project_id = x.project_id AND f.reporting_period = x.m
              LEFT JOIN (SELECT project_id, COUNT(*) AS n, CNT(status = 'delayed') AS late FROM milestones GROUP BY 1) ms ON ms.project_id = f.project_id
              LEFT JOIN (SELECT project_id, COUNT(*) AS n, CNT(availability IN ('limited', 'out_of_stock')) AS bad
                         FROM project_materials GROUP BY 1) sp ON sp.project_id = f.project_id
              LEFT JOIN (SELECT site_name, COUNT(*) AS n, CNT(severity = 'Critical') AS crit FROM incidents GROUP BY 1) h ON h.site_name = f.state)""",
    "financials_by_division": """
        SELECT division, COUNT(DISTINCT project_id) AS projects, TOT(budget_aud, 4) AS total_budget,
               TOT(actual_cost_aud, 4) AS total_actual_cost, AVGR(spi, 3, 4) AS avg_spi, AVGR(cpi, 3, 4) AS avg_cpi,
               CNT(actual_cost_aud > budget_aud) AS over_budget
        FROM financials GROUP BY 1""",
    "safety_summary": """
        SELECT site_name, division, COUNT(*) AS incidents, CNT(severity = 'Critical') AS critical_incidents,
               CNT(severity = 'Serious') AS serious_incidents, CNT(severity = 'Moderate') AS moderate_incidents,
               CNT(severity = 'Minor') AS minor_incidents, TOT(lost_time_days) AS lti_days,
               SHARE(status = 'closed') AS completion_rate_pct
        FROM incidents GROUP BY 1, 2""",
    "equipment_status": """
        SELECT t.equipment_id, equipment_type, manufacturer, site_name, division, status, engine_temp_celsius, fuel_level_pct,
               operating_hours, maintenance_due_date, COALESCE(n, 0) AS work_orders, COALESCE(c, 0) AS maintenance_cost_aud,
               COALESCE(d, 0) AS downtime_hours, last_work_date
        FROM tel_now t
        LEFT JOIN (SELECT equipment_id, COUNT(*) AS n, TOT(cost_aud) AS c, TOT(downtime_hours) AS d, MAX(work_date) AS last_work_date
                   FROM maintenance_log GROUP BY 1) w ON t.equipment_id = w.equipment_id""",
    "procurement_analytics": """
        SELECT supplier, category, n AS materials, DBL(s) AS total_spend_aud,
               RND(PCT(s, SUM(s) OVER (PARTITION BY category)), 1) AS category_share_pct, min_lead_days, median_lead_days, max_lead_days,
               RND(RATIO(sqrt(greatest(sq - mean * mean, CAST(0 AS DOUBLE))), mean), 4) AS price_volatility, supply_risk_items
        FROM (SELECT supplier, category, COUNT(*) AS n, SUM(DEC(total_cost_aud)) AS s, MIN(lead_time_days) AS min_lead_days,
                     DBL(quantile_cont(lead_time_days, 0.5)) AS median_lead_days, MAX(lead_time_days) AS max_lead_days,
                     MEAN(unit_price_aud) AS mean,
                     RATIO(SUM(CAST(unit_price_aud AS DECIMAL(12,2)) * CAST(unit_price_aud AS DECIMAL(12,2))), COUNT(*)) AS sq,
                     CNT(availability IN ('limited', 'out_of_stock')) AS supply_risk_items
              FROM materials GROUP BY 1, 2)""",
    "workforce_utilisation": """
        SELECT site_name, COUNT(DISTINCT employee_id) AS headcount, TOT(DEC(hours_regular) + DEC(hours_overtime)) AS total_hours,
               RND(RATIO(TOT(hours_overtime), TOT(DEC(hours_regular) + DEC(hours_overtime))) * CAST(100 AS DOUBLE), 1) AS overtime_pct,
               TOT(total_cost_aud, 4) AS labour_cost_aud, CNT(NOT is_inducted) AS uninducted_shifts
        FROM timesheets GROUP BY 1""",
    "compliance_dashboard": """
        SELECT site_name, monitor_type, COUNT(*) AS readings, CNT(is_exceedance) AS exceedances,
               SHARE(is_exceedance) AS exceedance_rate_pct, MAX(measurement_value) AS max_reading
        FROM emissions GROUP BY 1, 2""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _uses(sql: str) -> set[str]:
    return set(_WORD.findall(sql)) & VIEWS.keys()


def with_views(sql: str) -> str:
    """Prepend, in dependency order, every view that ``sql`` reaches, and expand the macros."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in sorted(_uses(VIEWS[name]) - {name}):
            visit(other)
        ordered.append(name)

    for name in sorted(_uses(sql)):
        visit(name)
    if not ordered:
        return expand(sql)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    body = sql.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    body = body[5:] if joiner == ",\n" else body
    return expand(f"WITH {ctes}{joiner}{body}")
