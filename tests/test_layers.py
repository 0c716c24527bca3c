"""Edge rows of the clean layer and the data products."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quarrylens.operators.evaluate import execution_match
from quarrylens.plans import gold, silver

T0, T1 = datetime(2025, 1, 1), datetime(2025, 1, 2)
LOADED = ("_ingested_at",)
AS_OF = date(2025, 7, 1)


def ping(i, speed=5.0, lat=-20.0, lon=130.0, on=True, at=T0, site="s"):
    return (i, "v", "t", site, lat, lon, speed, on, 50.0, "2025-01-01 08:00:00", "b", at, "f")


PINGS = (
    "ping_id string, vehicle_id string, vehicle_type string, site_name string, latitude double, longitude double, speed_kmh double, "
    "engine_on boolean, fuel_level_pct double, ping_timestamp string, batch_id string, _ingested_at timestamp, _source_file string"
)


def test_fleet_positions(spark):
    rows = [ping(str(i), s) for i, s in enumerate([-1.0, 0.0, 1.0, 1.01, 120.0, 121.0, None])]
    out = {r["ping_id"]: r for r in silver.fleet_positions(spark.createDataFrame(rows, PINGS), LOADED).collect()}
    assert [out[str(i)]["speed_kmh"] for i in range(7)] == [0.0, 0.0, 1.0, 1.01, 120.0, 120.0, None]
    assert [out[str(i)]["is_moving"] for i in range(7)] == [False, False, False, True, True, True, None]
    assert [out[str(i)]["is_idling"] for i in range(7)] == [True, True, True, False, False, False, None]
    assert "_ingested_at" not in silver.fleet_positions(spark.createDataFrame(rows, PINGS), LOADED).columns


@pytest.mark.parametrize(
    ("lat", "lon", "kept"),
    [(-45.0, 110.0, 1), (-10.0, 155.0, 1), (-45.1, 120.0, 0), (-9.9, 120.0, 0), (-20.0, 109.9, 0), (-20.0, 155.1, 0), (None, 120.0, 0)],
)
def test_bounding_box(spark, lat, lon, kept):
    assert silver.fleet_positions(spark.createDataFrame([ping("1", lat=lat, lon=lon)], PINGS), LOADED).count() == kept


def test_latest_load_wins_and_reload_changes_nothing(spark):
    df = spark.createDataFrame([ping("1", 10.0), ping("1", 20.0, at=T1), ping("2", 7.0)], PINGS)
    once = silver.fleet_positions(df, LOADED)
    assert {r["ping_id"]: r["speed_kmh"] for r in once.collect()} == {"1": 20.0, "2": 7.0}
    assert execution_match(silver.fleet_positions(df.unionAll(df), LOADED), once).first()["is_match"]


def receipt(i, qty=10, price=2.0, total=20.0, condition="good", at=T0):
    return (i, "sup", "steel", qty, price, total, "site", "po", "2025-02-30" if i == "bad" else "2025-02-03", condition, at, "f")


RECEIPTS = (
    "delivery_id string, supplier string, material string, quantity int, unit_price double, total_cost double, destination_site string, "
    "po_number string, delivery_date string, condition string, _ingested_at timestamp, _source_file string"
)


def test_deliveries(spark):
    rows = [
        receipt("a", total=20.19),
        receipt("b", total=20.2),
        receipt("c", total=20.21, condition="partial"),
        receipt("d", qty=0, condition="damaged"),
        receipt("e", qty=None, condition=None),
        receipt("bad"),
    ]
    out = {r["delivery_id"]: r for r in silver.deliveries(spark.createDataFrame(rows, RECEIPTS), LOADED).collect()}
    assert out["a"]["cost_validated"] and not out["c"]["cost_validated"]
    assert out["d"]["cost_variance_pct"] == 0.0 and out["e"]["cost_variance_pct"] == 0.0
    assert [out[k]["is_damaged"] for k in "abcde"] == [False, False, True, True, False]
    assert out["e"]["condition"] == "unknown"
    assert out["a"]["delivery_date"] == date(2025, 2, 3) and out["bad"]["delivery_date"] is None


def stock(material, on_hand, low, point=10):
    return ("w", "W", "r", material, on_hand, point, low, "2025-06-01", "2025-06-02 00:00:00", "b1", T0, "f")


STOCK = (
    "warehouse_id string, warehouse_name string, region string, material string, on_hand_qty int, reorder_point int, below_reorder boolean, "
    "last_replenished string, snapshot_timestamp string, batch_id string, _ingested_at timestamp, _source_file string"
)


def test_inventory_labels(spark):
    rows = [stock("a", 0, True), stock("b", -5, True), stock("c", 5, True), stock("d", 10, False), stock("e", 30, False), stock("f", 31, False)]
    out = {r["material"]: r for r in silver.inventory_snapshots(spark.createDataFrame(rows, STOCK), AS_OF, LOADED).collect()}
    assert [out[k]["stock_status"] for k in "abcdef"] == ["out_of_stock", "out_of_stock", "below_reorder", "healthy", "healthy", "overstocked"]
    assert out["b"]["on_hand_qty"] == 0 and out["a"]["days_since_replenishment"] == 30


def test_inventory_health_takes_newest_snapshot(spark):
    rows = [stock("a", 5, True), stock("a", 50, False)]
    rows[1] = rows[1][:8] + ("2025-06-09 00:00:00", "b2") + rows[1][10:]
    snaps = silver.inventory_snapshots(spark.createDataFrame(rows, STOCK), AS_OF, LOADED)
    assert [r["on_hand_qty"] for r in gold.inventory_health(snaps).collect()] == [50]


INVOICES = (
    "invoice_id string, supplier string, site string, invoice_date string, due_date string, subtotal_aud double, gst_aud double, "
    "total_aud double, payment_status string, _ingested_at timestamp, _source_file string"
)


def invoice(i, due, status="pending", gst=10.0, supplier="sup", site="site", total=110.0):
    return (i, supplier, site, "2025-05-01", due, 100.0, gst, total, status, T0, "f")


def test_invoices_and_aging(spark):
    days = {"a": -61, "b": -60, "c": -31, "d": -30, "e": -1, "f": 0, "g": 6, "h": 7, "i": 14, "j": 15, "k": 30, "l": 31}
    from datetime import timedelta

    rows = [invoice(k, str(AS_OF + timedelta(days=v))) for k, v in days.items()]
    rows += [
        invoice("m", "2025-01-01", "paid"),
        invoice("n", "2025-12-01", "disputed"),
        invoice("o", None),
        invoice("p", "2025-12-01", "approved"),
    ]
    aged = gold.invoice_aging(silver.invoices(spark.createDataFrame(rows, INVOICES), AS_OF, LOADED))
    out = {r["invoice_id"]: (r["aging_bucket"], r["payment_risk"]) for r in aged.collect()}
    assert out == {
        "a": ("overdue_90_plus", "high"),
        "b": ("overdue_60", "high"),
        "c": ("overdue_60", "high"),
        "d": ("overdue_30", "medium"),
        "e": ("overdue_30", "medium"),
        "f": ("due_imminent", "medium"),
        "g": ("due_imminent", "medium"),
        "h": ("due_imminent", "low"),
        "i": ("due_imminent", "low"),
        "j": ("due_soon", "low"),
        "k": ("due_soon", "low"),
        "l": ("not_yet_due", "low"),
        "m": ("settled", "medium"),
        "n": ("not_yet_due", "high"),
        "o": ("overdue_90_plus", "low"),
        "p": ("settled", "low"),
    }


def test_gst_tolerance(spark):
    rows = [invoice("a", "2025-08-01", gst=10.99), invoice("b", "2025-08-01", gst=11.0), invoice("c", "2025-08-01", gst=9.0)]
    out = {r["invoice_id"]: r["gst_validated"] for r in silver.invoices(spark.createDataFrame(rows, INVOICES), AS_OF, LOADED).collect()}
    assert out == {"a": True, "b": False, "c": False}


def test_site_summary_keeps_one_sided_and_null_sites(spark):
    pos = silver.fleet_positions(spark.createDataFrame([ping("1", site="x"), ping("2", site=None)], PINGS), LOADED)
    dlv = silver.deliveries(spark.createDataFrame([receipt("a")], RECEIPTS), LOADED)
    inv = silver.invoices(spark.createDataFrame([invoice("i", "2025-01-01", site="x"), invoice("j", "2025-01-01", site=None)], INVOICES), AS_OF, LOADED)
    out = sorted(((r["site_name"] or "", r["active_vehicles"], r["total_deliveries"], r["overdue_amount_aud"]) for r in gold.site_operations_summary(pos, dlv, inv).collect()), key=str)
    # A missing site never matches another missing site: one row per side.
    assert out == sorted([("", 1, None, None), ("", None, None, 110.0), ("site", None, 1, None), ("x", 1, None, 110.0)], key=str)


def test_supplier_tiers_use_unrounded_score_and_one_sided_suppliers(spark):
    dlv = spark.createDataFrame(
        [("s1", "site", 1.0, i < damaged, True) for damaged in [1] for i in range(20)] + [("only_delivers", "site", 1.0, False, True)],
        "supplier string, destination_site string, total_cost double, is_damaged boolean, cost_validated boolean",
    )
    inv = spark.createDataFrame(
        [("s1", 1.0, "pending", False), ("only_bills", 5.0, "disputed", False), ("only_bills", 5.0, "pending", True)],
        "supplier string, total_aud double, payment_status string, is_overdue boolean",
    )
    out = {r["supplier"]: r for r in gold.supplier_scorecard(dlv, inv).collect()}
    assert (out["s1"]["supplier_score"], out["s1"]["supplier_tier"]) == (90.0, "A - Preferred")
    assert (out["only_delivers"]["supplier_score"], out["only_delivers"]["invoices"]) == (100.0, None)
    # 100 - 50 % overdue - one dispute
    assert (out["only_bills"]["supplier_score"], out["only_bills"]["supplier_tier"]) == (45.0, "D - Review Required")


def test_fleet_daily_counts(spark):
    rows = [ping("1", 0.0), ping("2", 50.0), ping("3", 100.0), ping("4", 0.5, on=False)]
    r = gold.fleet_utilisation_daily(silver.fleet_positions(spark.createDataFrame(rows, PINGS), LOADED)).collect()[0]
    assert (r["total_pings"], r["moving_pings"], r["idling_pings"], r["off_pings"]) == (4, 2, 1, 1)
    assert (r["avg_speed_kmh"], r["utilisation_pct"], r["idle_pct"]) == (37.6, 50.0, 25.0)
    assert r["report_date"] == date(2025, 1, 1)


def test_hot_key_dedup(spark):
    """One key holds a third of all rows; it still gives one row and the map side prunes it."""
    from quarrylens.operators.latest import dedup_latest

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = dedup_latest(df, ["k"], ["v"])
    assert out.count() == 20_001
    assert out.filter("k = -1").first()["v"] == 29_997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_dedup_survivor_does_not_depend_on_partitions(spark, partitions):
    rows = [ping("1", speed=float(i % 7), on=i % 2 == 0, site=f"s{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, PINGS).repartition(partitions)
    kept = silver.fleet_positions(df, LOADED).collect()
    assert [(r["speed_kmh"], r["engine_on"], r["site_name"]) for r in kept] == [(6.0, True, "s2")]
