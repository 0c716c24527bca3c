"""Threshold rows of every business rule."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import predicates as P
from quarrylens.functions import rules
from quarrylens.functions.numeric import clamp, fmt_money, pct, ratio, rnd
from quarrylens.functions.vocab import canonical


def values(spark, ddl, rows, *cols):
    df = spark.createDataFrame(rows, ddl)
    out = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()
    return [r[0] if len(cols) == 1 else tuple(r) for r in out]


def test_rounding_is_half_away_from_zero(spark):
    got = values(spark, "x double", [(0.25,), (-0.25,), (2.5,), (-2.5,), (-0.01,), (None,)], rnd("x", 1))
    assert got == [0.3, -0.3, 2.5, -2.5, 0.0, None]
    assert [str(v) for v in got][4] == "0.0"


def test_ratio_and_pct_guard_zero(spark):
    got = values(spark, "a double, b double", [(1.0, 0.0), (1.0, 4.0), (None, 2.0)], ratio("a", "b"), pct("a", "b"))
    assert got == [(None, None), (0.25, 25.0), (None, None)]


def test_clamp_keeps_null(spark):
    assert values(spark, "x double", [(-1.0,), (0.0,), (120.0,), (121.0,), (None,)], clamp("x", 0.0, 120.0)) == [0.0, 0.0, 120.0, 120.0, None]


def test_evm_worked_example(spark):
    row = values(
        spark,
        "ev double, ac double, pv double",
        [(420.0, 412.0, 420.0)],
        rules.cv("ev", "ac"),
        rules.sv("ev", "pv"),
        rnd(rules.cpi("ev", "ac"), 3),
        rnd(rules.spi("ev", "pv"), 3),
    )
    assert row == [(8.0, 0.0, 1.019, 1.0)]


def test_eac_and_vac(spark):
    got = values(spark, "b double, c double", [(100.0, 0.8), (100.0, 0.0)], rules.eac("b", "c"), rules.vac("b", "c"))
    assert got == [(125.0, -25.0), (None, None)]


@pytest.mark.parametrize(
    ("profile", "cv", "spi", "cpi", "want"),
    [
        ("controls", 0.0, 1.0, 1.0, "green"),
        ("controls", 0.0, 0.95, 1.0, "amber"),
        ("controls", 0.0, 0.949, 1.0, "red"),
        ("controls", -5.1, 1.0, 1.0, "red"),
        ("governance", -4.9, 0.96, 0.96, "green"),
        ("governance", -5.0, 0.96, 0.96, "amber"),
        ("governance", 0.0, 0.95, 1.0, "amber"),
        ("governance", 0.0, 0.85, 1.0, "amber"),
        ("governance", 0.0, 0.84, 1.0, "red"),
        ("governance", -10.1, 1.0, 1.0, "red"),
        ("governance", 0.0, None, None, "green"),
    ],
)
def test_rag(spark, profile, cv, spi, cpi, want):
    assert values(spark, "v double, s double, c double", [(cv, spi, cpi)], rules.rag("v", "s", "c", profile)) == [want]


def test_approver_bands(spark):
    rows = [(499_999.0,), (500_000.0,), (2_000_000.0,), (5_000_000.0,), (20_000_000.0,), (20_000_001.0,)]
    got = values(spark, "v double", rows, rules.approver("v"))
    assert got == [
        "Project Manager",
        "Senior Project Manager",
        "Divisional Director",
        "Executive Committee",
        "Executive Committee",
        "Board of Directors",
    ]


def test_risk_class(spark):
    rows = [(0.84, 1.0), (0.94, 1.0), (1.0, 0.99), (1.0, 1.0)]
    assert values(spark, "c double, s double", rows, rules.risk_class("c", "s")) == ["Critical", "High", "Medium", "Low"]


def test_temperature_levels(spark):
    rows = [(95.0,), (105.0,), (105.1,), (110.0,), (110.1,), (None,)]
    got = values(spark, "t double", rows, rules.temp_alert("t"), rules.temp_alert("t", 94.0))
    assert got == [
        (None, "WARNING"),
        (None, "WARNING"),
        ("WARNING", "WARNING"),
        ("WARNING", "WARNING"),
        ("CRITICAL", "CRITICAL"),
        (None, None),
    ]


def test_fuel_and_pressure_bands(spark):
    got = values(spark, "f double", [(9.9,), (10.0,), (20.0,), (50.0,), (50.1,), (None,)], rules.fuel_band("f"))
    assert got == ["critical", "low", "low", "fair", "good", None]
    got = values(spark, "p double", [(99.0,), (100.0,), (149.0,), (150.0,), (200.0,), (350.0,), (351.0,), (400.0,), (401.0,)], rules.hydraulic_band("p"))
    assert got == ["critical", "warning", "warning", "low_normal", "normal", "normal", "warning", "warning", "critical"]


def test_overdue_and_priority(spark):
    day = date(2025, 4, 20)
    rows = [(date(2025, 4, 20), "operational"), (date(2025, 4, 13), "maintenance"), (date(2025, 4, 12), "critical"), (None, "critical")]
    got = values(spark, "d date, s string", rows, rules.overdue("d", day, "s"), rules.overdue_priority("d", day))
    assert got == [(False, "MEDIUM"), (False, "MEDIUM"), (True, "HIGH"), (None, "MEDIUM")]


def test_service_intervals(spark):
    assert values(spark, "h int", [(250,), (999,), (1000,), (10_000,), (10_001,)], rules.service_due("h")) == [
        "minor",
        "none",
        "major",
        "major",
        "major_review",
    ]


def test_equipment_type_from_number(spark):
    assert values(spark, "e string", [("HT-001",), ("wc-7",), ("ZZ-1",)], rules.equipment_type_of("e")) == ["haul_truck", "water_cart", None]


def test_frequency_rates(spark):
    assert values(spark, "n int, h double", [(2, 400_000.0), (1, 0.0)], rules.ltifr("n", "h")) == [5.0, None]


def test_procurement_rules(spark):
    rows = [("increasing", "good", 31), ("increasing", "limited", 5), ("stable", "out_of_stock", 61), ("increasing", "good", 30)]
    got = values(
        spark,
        "t string, a string, l int",
        rows,
        rules.procurement_risk("t", "a", "l"),
        rules.supply_risk("a"),
        rules.lead_band("l"),
    )
    assert got == [(True, False, "long"), (True, True, "normal"), (False, True, "critical"), (False, False, "normal")]


def test_money_format(spark):
    rows = [(950.4,), (12_345.0,), (45_200_000.0,), (3_200_000_000.0,), (-2_500_000.0,)]
    assert values(spark, "x double", rows, fmt_money("x")) == ["$950", "$12,345", "$45.2M", "$3.2B", "-$2.5M"]


def test_forecast(spark):
    assert values(spark, "r double, s double", [(9.0, 0.9)], rnd(rules.forecast_delay("r", "s"), 6)) == [1.0]


def test_vocabulary(spark):
    rows = [(" Rising",), ("increasing",), (None,)]
    assert values(spark, "x string", rows, canonical(F.col("x"), "price_trend")) == ["increasing", "increasing", None]
    assert values(spark, "x string", [("Backordered",), ("Discontinued",), ("In Stock",)], canonical(F.col("x"), "availability")) == [
        "limited",
        "out_of_stock",
        "good",
    ]
    assert values(spark, "x string", [("MAJOR",), ("critical",)], canonical(F.col("x"), "severity")) == ["Serious", "Critical"]
    assert values(spark, "x string", [("Acme Build",), ("acme-mining",)], canonical(F.col("x"), "division", "acme")) == ["build", "mining"]


def test_date_windows(spark):
    day = date(2024, 6, 30)
    rows = [(date(2024, 3, 29),), (date(2024, 3, 30),), (date(2024, 7, 1),), (date(2023, 12, 31),), (None,)]
    got = values(
        spark,
        "d date",
        rows,
        P.since_months("d", day, 3),
        P.same_year("d", day),
        P.within_days("d", day, 7),
        P.quarter_of("d", day),
        P.previous_month("d", date(2024, 4, 2)),
    )
    assert got == [
        (False, True, False, False, True),
        (True, True, False, False, True),
        (True, True, True, False, False),
        (False, False, False, False, False),
        (None,) * 5,
    ]


def test_safe_casts(spark):
    got = values(spark, "x string", [("2024-02-30",), ("2024-02-29",), ("soon",)], P.to_date_safe("x"))
    assert got == [None, date(2024, 2, 29), None]


def test_filters(spark):
    df = spark.createDataFrame([(1, "dust_pm10"), (2, "noise_db"), (None, "dust_pm2_5")], "a int, b string")
    assert [r[0] for r in df.select(P.default_null("a", 0)).collect()] == [1, 2, 0]
    assert [r[0] for r in df.select(P.domain_rank("b", ["noise_db", "dust_pm10"])).collect()] == [2, 1, 3]
