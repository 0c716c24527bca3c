"""Catalogue questions on the seed rows, against the published answers."""

from __future__ import annotations

from datetime import date

import pytest
import seed_rows
from pyspark.sql import functions as F

from quarrylens.operators import security
from quarrylens.plans.catalogue import CATALOGUE
from quarrylens.plans.rollups import portfolio_health, project_kpis
from quarrylens.sources import schemas
from quarrylens.sources.tables import Tables

DAY = date(2025, 4, 19)


@pytest.fixture(scope="module")
def seeds(spark):
    frame = spark.createDataFrame
    return Tables(
        spark,
        {
            "financials": frame(seed_rows.FINANCIALS, schemas.FINANCIALS).withColumn("pct_complete", F.lit(50.0)),
            "telemetry": frame(seed_rows.TELEMETRY, schemas.TELEMETRY),
            "incidents": frame(seed_rows.INCIDENTS, schemas.INCIDENTS).withColumn("is_near_miss", F.col("injuries") == 0),
            "materials": frame(seed_rows.MATERIALS, schemas.MATERIALS),
            "bill": frame([("MAT-001", 200)], "material_id string, qty bigint"),
            "market_prices": frame([("Steel", 2800.0)], "category string, market_price_aud double"),
        },
    )


def ask(seeds, key, **params):
    return [r.asDict() for r in CATALOGUE[key](seeds, **params).collect()]


def test_row_counts(seeds):
    assert [seeds[n].count() for n in ("financials", "telemetry", "incidents", "materials")] == [10, 10, 7, 10]


def test_red_projects(seeds):
    rows = ask(seeds, "q_pj_01")
    assert [r["project_name"] for r in rows] == ["Project 8", "Project 3", "Project 5"]


def test_open_incidents(seeds):
    assert [r["incident_id"] for r in ask(seeds, "q_sf_01")] == ["INC-007", "INC-006", "INC-005"]


def test_highest_failure_risk(seeds):
    worst = ask(seeds, "q_eq_25", as_of=DAY, k=1)[0]
    assert (worst["equipment_id"], worst["status"], worst["site_equipment_incidents"]) == ("EX-002", "critical", 1)


def test_cost_estimate(seeds):
    (row,) = ask(seeds, "q_pr_25")
    assert (row["internal_cost_aud"], row["market_cost_aud"], row["overpaying"]) == (570_000.0, 560_000.0, True)


def test_incidents_by_division(seeds):
    rows = ask(seeds, "q_x_01_safe")
    assert {r["division"]: r["incidents"] for r in rows} == {"Build": 3, "Mining": 3, "Engineering": 1}


def test_rising_prices(seeds):
    assert [r["material_name"] for r in ask(seeds, "q_pr_01")] == ["Cutting Tools", "Structural Steel", "Diesel"]


def test_alerts_and_overdue(seeds):
    assert [r["equipment_id"] for r in ask(seeds, "q_eq_01")] == ["EX-002", "HT-002", "HT-004"]
    assert [r["equipment_id"] for r in ask(seeds, "q_eq_03", as_of=DAY)] == ["EX-002", "HT-004"]


def test_largest_projects_and_overruns(seeds):
    assert [r["project_name"] for r in ask(seeds, "q_pj_04", k=2)] == ["Project 3", "Project 7"]
    assert [r["overrun_m"] for r in ask(seeds, "q_pj_13")] == [250.0, 30.0, 25.0]


@pytest.mark.parametrize(("groups", "visible"), [(["Group-Build"], 5), (["Group-Mining"], 3), (["Group-Executives"], 10), ([], 0), (["Group-Build", "Group-Mining"], 8)])
def test_visible_projects(seeds, groups, visible):
    policy = security.Policy({f"Group-{d}": d for d in ("Build", "Mining", "Engineering")}, masked=("budget_aud",))
    assert security.secure(seeds["financials"], groups, policy).count() == visible


def test_masks_never_reveal(seeds):
    policy = security.Policy({"Group-Build": "Build"}, masked=("budget_aud",))
    df = seeds["financials"].withColumn("budget_aud", F.col("budget_aud") + 123_456.0)
    seen = [r["budget_aud"] for r in security.secure(df, ["Group-Build"], policy).collect()]
    assert all(v % 1e6 == 0 for v in seen)
    full = [r["budget_aud"] for r in security.secure(df, ["admins"], policy).collect()]
    assert all(v % 1e6 == 123_456.0 for v in full)


def test_union_of_divisions_is_executive_view(seeds):
    mapping = {f"Group-{d}": d for d in ("Build", "Mining", "Engineering")}
    policy = security.Policy(mapping)
    ids = lambda groups: {r["project_id"] for r in security.secure(seeds["financials"], groups, policy).collect()}
    assert set().union(*(ids([g]) for g in mapping)) == ids(["Group-Executives"])


def test_membership_tables_agree_with_explicit_groups(spark, seeds):
    members = spark.createDataFrame(
        [("ana", "Group-Build"), ("ana", "Group-Mining"), ("boss", "Group-Executives")], "principal string, group_name string"
    )
    mapping = spark.createDataFrame([(f"Group-{d}", d) for d in ("Build", "Mining", "Engineering")], "group_name string, division string")
    counts = {p: security.secure_by_membership(seeds["financials"], p, members, mapping).count() for p in ("ana", "boss", "nobody")}
    assert counts == {"ana": 8, "boss": 10, "nobody": 0}
    seen = security.verify_visibility({"incidents": seeds["incidents"]}, members, mapping).collect()
    assert {(r["principal"], r["division"]): r["row_count"] for r in seen} == {
        ("ana", "Build"): 3,
        ("ana", "Mining"): 3,
        ("boss", "Build"): 3,
        ("boss", "Mining"): 3,
        ("boss", "Engineering"): 1,
    }


def test_roles_without_match_show_nothing(seeds):
    roles = [security.Role("BuildSafety", "Group-Build", "incidents", F.col("division") == "Build")]
    assert security.apply_roles(seeds["incidents"], "incidents", roles, ["Group-Build"]).count() == 3
    assert security.apply_roles(seeds["financials"], "financials", roles, ["Group-Build"]).count() == 0


def test_portfolio_health(seeds):
    kpis = project_kpis(seeds["financials"])
    rows = {r["division"]: (r["avg_cpi"], r["avg_spi"], r["red_projects"]) for r in kpis.collect()}
    assert rows["Engineering"] == (1.02, 1.01, 0) and rows["Mining"] == (0.94, 0.983, 2)
    mean = sum((c + s) / 2 for c, s, _ in rows.values()) / 3
    assert portfolio_health(kpis).first()[0] == pytest.approx(mean, abs=1e-4)


def test_literal_and_safe_forms_differ_only_by_repetition(seeds):
    """Lost days of a division repeat once per project snapshot in the published join."""
    literal = {r["division"]: r["lti_days"] for r in ask(seeds, "q_x_01")}
    safe = {r["division"]: r["lti_days"] for r in ask(seeds, "q_x_01_safe")}
    assert literal == {"Build": 0.0, "Mining": 3.5 * 3, "Engineering": 2.0 * 2}
    assert safe == {"Build": 0.0, "Mining": 3.5, "Engineering": 2.0}
