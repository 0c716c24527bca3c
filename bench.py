"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from quarrylens import build_session
from quarrylens.registry import registered

HEADLINE = """
silver_fleet_positions silver_deliveries silver_inventory silver_invoices
gold_fleet_utilisation_daily gold_delivery_performance gold_inventory_health gold_invoice_aging
gold_site_operations_summary gold_supplier_scorecard
project_kpis monthly_kpis exec_scorecard project_risk_matrix
q_pj_19 q_pj_23 q_sf_11 q_sf_21 q_eq_08 q_eq_14 q_pr_12 q_pr_17 q_pr_20 q_wf_01 q_x_01 q_x_02 q_x_05
k7_verify_visibility j4_stream_fleet_daily s2_keyword_topk s3_vector_topk s5_execution_match
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    runs = registered()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        runs[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
