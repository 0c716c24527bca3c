"""Landing files, conforming, sinks and the whole batch chain."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from quarrylens.operators import security
from quarrylens.plans import pipeline
from quarrylens.sources import feed_source, landing, schemas, sinks
from quarrylens.sources.tables import Tables

AT = datetime(2025, 7, 1, 6)


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for batch in ("20250630_0600", "20250701_0600"):
        folder = root / batch
        for feed in schemas.FEEDS:
            (folder / feed).mkdir(parents=True)
        header = ",".join(schemas.GPS_PINGS.names)
        pings = [
            f"p1,v1,haul_truck,North,-20.5,130.5,40.0,90.0,true,55.0,2025-06-30T08:00:00,{batch}",
            f"p2,v1,haul_truck,North,-20.5,130.5,0.5,90.0,true,54.0,2025-06-30T09:00:00,{batch}",
            f"p3,v2,crane,North,5.0,130.5,10.0,90.0,true,54.0,2025-06-30T09:00:00,{batch}",
            f"p4,v2,crane,North,-20.0,130.5,fast,90.0,true,54.0,2025-06-30T09:00:00,{batch}",
        ]
        (folder / "gps_pings" / "part.csv").write_text("\n".join([header, *pings]) + "\n")
        receipts = [
            {"delivery_id": "d1", "supplier": "s1", "material": "steel", "quantity": 10, "unit_price": 2.0, "total_cost": 20.0,
             "destination_site": "North", "po_number": "po1", "delivery_date": "2025-06-01", "condition": "good", "batch_id": batch},
            {"delivery_id": "d2", "supplier": "s1", "material": "rebar", "quantity": 10, "unit_price": 2.0, "total_cost": 25.0,
             "destination_site": "South", "po_number": "po2", "delivery_date": "2025-06-02", "batch_id": batch},
        ]
        (folder / "delivery_receipts" / "part.json").write_text("\n".join(json.dumps(r) for r in receipts))
        header = ",".join(schemas.WAREHOUSE_STOCK.names)
        (folder / "warehouse_stock" / "part.csv").write_text(
            f"{header}\nw1,W,R,steel,5,10,t,true,2025-06-01,2025-06-30 00:00:00,{batch}\nw1,W,R,rebar,0,10,t,true,2025-06-01,2025-06-30 00:00:00,{batch}\n"
        )
        header = ",".join(schemas.SUPPLIER_INVOICES.names)
        (folder / "supplier_invoices" / "part.csv").write_text(
            f"{header}\ni1,s1,po1,2025-05-01,2025-05-31,1,100.0,10.0,110.0,AUD,pending,North,{batch}\ni2,s2,po2,2025-06-20,2025-07-20,1,50.0,5.0,55.0,AUD,paid,East,{batch}\n"
        )
    return str(root)


def test_resolve_batch(spark, feeds, tmp_path):
    assert landing.resolve_batch(spark, feeds).endswith("/20250701_0600")
    assert landing.resolve_batch(spark, feeds, "x").endswith("/x")
    with pytest.raises(FileNotFoundError):
        landing.resolve_batch(spark, str(tmp_path))


def test_feed_meta_and_conform(spark, feeds):
    schema, fmt = schemas.FEEDS["gps_pings"]
    raw = landing.with_ingest_meta(landing.read_feed(spark, f"{feeds}/20250701_0600/gps_pings", fmt, schema, text=True), AT)
    assert raw.filter(F.col("_source_file").endswith("part.csv")).count() == 4
    good, bad = landing.split_rejects(landing.conform(raw, schema, keep=("_ingested_at",), report=True))
    assert good.count() == 3 and good.schema["speed_kmh"].dataType == schema["speed_kmh"].dataType
    assert [(r["ping_id"], r[landing.BAD_COLUMNS]) for r in bad.collect()] == [("p4", ["speed_kmh"])]


def test_conform_adds_missing_columns(spark):
    out = landing.conform(spark.createDataFrame([("1",)], "ping_id string"), schemas.GPS_PINGS)
    assert out.columns == schemas.GPS_PINGS.names and out.first()["speed_kmh"] is None


def test_batch_chain(spark, feeds):
    loaded = pipeline.run_bronze(spark, feeds, "t_bronze", AT)
    assert loaded["gps_pings"] == 3 and loaded["gps_pings_rejects"] == 1 and loaded["delivery_receipts"] == 2
    clean = pipeline.run_silver(spark, "t_bronze", "t_silver", date(2025, 7, 1), AT)
    assert clean == {"fleet_positions": 2, "deliveries": 2, "inventory_snapshots": 2, "invoices": 2}
    products = pipeline.run_gold(spark, "t_silver", "t_gold", AT)
    assert products["supplier_scorecard"] == 2 and products["site_operations_summary"] == 3
    score = {r["supplier"]: r["supplier_tier"] for r in spark.table("t_gold.supplier_scorecard").collect()}
    assert score == {"s1": "D - Review Required", "s2": "A - Preferred"}

    # Loading the same batch again leaves raw and clean rows as they were; another batch adds its rows.
    assert pipeline.run_bronze(spark, feeds, "t_bronze", AT) == loaded
    assert spark.table("t_bronze.gps_pings").count() == 3 and spark.table("t_bronze.gps_pings_rejects").count() == 1
    assert pipeline.run_silver(spark, "t_bronze", "t_silver", date(2025, 7, 1), AT) == clean
    assert "_processed_at" in spark.table("t_silver.deliveries").columns
    pipeline.run_bronze(spark, feeds, "t_bronze", datetime(2025, 6, 30), "20250630_0600")
    assert spark.table("t_bronze.gps_pings").count() == 6 and spark.table("t_bronze.gps_pings_rejects").count() == 2
    assert [r[landing.BAD_COLUMNS] for r in spark.table("t_bronze.gps_pings_rejects").collect()] == [["speed_kmh"]] * 2


def test_tables_and_views(spark):
    sinks.ensure_db(spark, "t_sinks", "it's a test")
    sinks.ensure_table(spark, "t_sinks.inc", schemas.INCIDENTS, properties={"domain": "hse"}, comment="incidents")
    sinks.ensure_table(spark, "t_sinks.gps", schemas.GPS_PINGS, partition_by=["batch_id"])
    assert sinks.table_kind(spark, "t_sinks.inc") == "MANAGED" and sinks.table_kind(spark, "t_sinks.none") == "ABSENT"
    assert sinks.table_properties(spark, "t_sinks.inc").filter("key = 'domain'").first()["value"] == "hse"
    notes = {c.name: c.description for c in spark.catalog.listColumns("t_sinks.gps")}
    assert notes["engine_on"] == "ignition state"

    df = spark.range(5).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))
    assert sinks.replace(df, "t_sinks.t") == 5 and sinks.append(df, "t_sinks.t") == 5
    assert spark.table("t_sinks.t").count() == 10
    sinks.overwrite_rows(spark.range(3).select(F.lit("y").alias("b"), F.col("id").alias("a")), "t_sinks.t")
    assert spark.table("t_sinks.t").filter("b = 'y'").count() == 3
    assert sinks.mirror_copy(spark, "t_sinks.t", "t_sinks.t_copy") == 3
    sinks.define_view(spark, "t_sinks.v", "SELECT a FROM t_sinks.t WHERE a > 0", "positive")
    assert spark.table("t_sinks.v").count() == 2
    sinks.materialise(spark.table("t_sinks.v"), "t_sinks.mv", mode="both")
    sinks.materialise(spark.table("t_sinks.v"), "t_sinks.live", mode="view")
    assert spark.table("t_sinks.mv").count() == spark.table("v_t_sinks_mv").count() == spark.table("v_t_sinks_live").count() == 2
    sinks.overwrite_rows(spark.range(9).select(F.lit("z").alias("b"), F.col("id").alias("a")), "t_sinks.t")
    assert spark.table("t_sinks.mv").count() == 2 and spark.table("v_t_sinks_mv").count() == 8
    sinks.overwrite_rows(spark.range(3).select(F.lit("y").alias("b"), F.col("id").alias("a")), "t_sinks.t")
    security.mirror_view("unfiltered", spark.table("t_sinks.t"))
    assert spark.table("unfiltered").count() == 3
    assert {r["table_name"]: r["row_count"] for r in sinks.audit_counts({"t": spark.table("t_sinks.t"), "v": spark.table("t_sinks.v")}).collect()} == {"t": 3, "v": 2}
    sinks.drop_if_exists(spark, "t_sinks.v", "VIEW")
    assert "v" not in sinks.table_names(spark, "t_sinks")


def test_export(spark, tmp_path):
    df = spark.range(10).repartition(4)
    sinks.export(df, str(tmp_path / "many"), "json")
    sinks.export(df, str(tmp_path / "one"), "csv", files=1)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 < len(list((tmp_path / "many").glob("part-*")))
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 10


def test_registry_is_lazy(spark):
    def fail(_):
        raise AssertionError("built although never asked for")

    t = Tables(spark, {"a": lambda t: t.spark.range(3), "b": lambda t: t["a"].filter("id > 0"), "c": fail})
    assert t["b"].count() == 2 and t["a"] is t["a"] and set(t) == {"a", "b", "c"}
    got = t.sql("SELECT count(*) AS n FROM {a} JOIN {b} USING (id) WHERE id <> :skip", skip=1)
    assert got.first()["n"] == 1
    t = Tables(spark, {"a": spark.range(2)})
    t.register_views("reg_")
    assert spark.sql("SELECT * FROM reg_a WHERE id >= :low", args={"low": 1}).count() == 1


PINGS_BY_NAME = [
    ("a", "ping_id,speed_kmh,batch_id", "1,9.5,b"),
    ("b", "batch_id,ping_id,speed_kmh,colour", "b,2,8.5,red"),
    ("c", "speed_kmh,ping_id", "fast,3"),
    ("d", "ping_id", "4"),
]


def _drifting(root):
    for name, header, row in PINGS_BY_NAME:
        folder = root / name / "pings"
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(f"{header}\n{row}\n")
    return str(root)


def _seen(rows):
    return sorted((r["ping_id"], r["speed_kmh"], r["batch_id"], r[landing.BAD_COLUMNS]) for r in rows.collect())


EXPECTED = [("1", 9.5, "b", []), ("2", 8.5, "b", []), ("3", None, None, ["speed_kmh"]), ("4", None, None, [])]
SHORT = schemas.schema("ping_id string, speed_kmh double, batch_id string")


def test_csv_is_read_by_header_name(spark, tmp_path):
    path = _drifting(tmp_path)
    raw = landing.with_ingest_meta(landing.read_feed(spark, f"{path}/*/pings", "csv", SHORT, text=True), AT)
    rows = landing.conform(raw, SHORT, keep=("_source_file",), report=True)
    assert _seen(rows) == EXPECTED
    assert rows.filter(F.col("_source_file").endswith("part.csv")).count() == 4


def test_stream_ingest_by_name_with_rejects(spark, tmp_path):
    from quarrylens.streaming import jobs

    path = _drifting(tmp_path / "landing")
    out, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for _ in range(2):
        jobs.run_to_end(jobs.stream_ingest(spark, path, "pings", "csv", SHORT, out, checkpoint, AT, files_per_trigger=1))
    log = jobs.read_log(spark, out)
    assert log.select("_batch").distinct().count() == 4
    assert _seen(log) == EXPECTED
    assert [r["ping_id"] for r in log.filter("_rejected = 1").collect()] == ["3"]


@pytest.mark.parametrize("size", [1, 7, 64, 10**6])
def test_each_line_is_read_by_one_range(tmp_path, size):
    lines = ["id,name", "1,a", "", "22,bb\r", "3,ü", "4444444444,last without end"]
    (tmp_path / "b1" / "f").mkdir(parents=True)
    (tmp_path / "b1" / "f" / "x.csv").write_text("\n".join(lines), encoding="utf-8")
    found = feed_source.find(f"{tmp_path}/*/f")
    options = {"paths": "[]", "columns": json.dumps(["name", "none"]), "format": "csv"}
    reader = feed_source.FeedReader(options)
    rows = []
    for part in feed_source.deal(found, size):
        for batch in reader.read(part):
            rows += batch.to_pylist()
    assert [r["value"] for r in rows] == ["1,a", "22,bb", "3,ü", "4444444444,last without end"]
    assert {(tuple(r["places"]), r["width"], r["_batch"]) for r in rows} == {((2, 0), 2, "b1")}


def test_folders_are_pruned_and_small_files_share_a_task(spark, tmp_path, monkeypatch):
    for b in range(6):
        (tmp_path / f"b{b}" / "f").mkdir(parents=True)
        for i in range(3):
            (tmp_path / f"b{b}" / "f" / f"{i}.csv").write_text(f"ping_id,speed_kmh\n{b}{i},1.5\n")
    rows = landing.read_lines(spark, f"{tmp_path}/*/f", "csv", SHORT)
    assert rows.rdd.getNumPartitions() == 1 and rows.count() == 18
    some = rows.where(F.col("_batch").isin("b1", "b4"))
    assert sorted(r["ping_id"] for r in some.collect()) == ["10", "11", "12", "40", "41", "42"]
    assert {f.batch for f in feed_source.find(f"{tmp_path}/*/f", {"b1"})} == {"b1"}
    # Folders of other batches are not even listed.
    asked = []
    children = feed_source._children
    monkeypatch.setattr(feed_source, "_children", lambda s, folder: asked.append(folder) or children(s, folder))
    feed_source.find(f"{tmp_path}/*/f", {"b2"})
    assert sorted(a.removeprefix(str(tmp_path)) for a in asked) == ["", "/b2", "/b2/f"]
    reader = feed_source.FeedReader({"paths": json.dumps([f"{tmp_path}/*/f"]), "columns": "[]"})
    left = list(reader.pushFilters([EqualTo(("_batch",), "b3"), EqualTo(("value",), "x")]))
    assert reader.batches == {"b3"} and len(left) == 1 and len(reader.partitions()[0].pieces) == 3


def test_feeds_are_read_where_sources_take_no_filters(spark, tmp_path):
    """A session made by others has the setting off, as Spark's default is."""
    for b in ("b1", "b2"):
        (tmp_path / b / "f").mkdir(parents=True)
        (tmp_path / b / "f" / "a.csv").write_text(f"ping_id,speed_kmh\n{b},1.5\n")
    setting = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(setting, "false")
    try:
        rows = landing.read_lines(spark, f"{tmp_path}/*/f", "csv", SHORT)
        assert sorted(r["ping_id"] for r in rows.collect()) == ["b1", "b2"]
        assert [r["ping_id"] for r in rows.where("_batch = 'b2'").collect()] == ["b2"]
    finally:
        spark.conf.set(setting, "true")


def test_short_and_long_lines_with_and_without_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ping_id,other,speed_kmh\n1\n2,x,2.5\n3,x,3.5,y,z\n"4",x,4.5\n"5,x\n6,\\,6.5\n,,\n' + "7,x,7.5" + "," * 200 + "\n")
    rows = landing.read_lines(spark, str(tmp_path / "a.csv"), "csv", SHORT)
    seen = [(r["ping_id"], r["speed_kmh"]) for r in rows.collect()]
    assert seen == [("1", None), ("2", "2.5"), ("3", "3.5"), ("4", "4.5"), ("5,x", None), ("6", "6.5"), (None, None), ("7", "7.5")]
    # Lines without quotes are as long as the parser expects, so none costs it an exception.
    lines = spark.createDataFrame([("1",), ("2,x",), ('"3",x',), ("4,x,y,z",)], "value string")
    assert [r[0] for r in lines.select(landing.filled("value", 3)).collect()] == ["1,,", "2,x,", '"3",x', "4,x,y,z"]


def test_a_stream_lists_its_folders_once_for_many_triggers(tmp_path, monkeypatch):
    for i in range(7):
        (tmp_path / f"{i}.csv").write_text("a\n1\n")
    lists = []
    find = feed_source.find
    monkeypatch.setattr(feed_source, "find", lambda *a: lists.append(a) or find(*a))
    options = {"paths": json.dumps([str(tmp_path / "*.csv")]), "columns": "[]", "log": str(tmp_path / "log"), "files_per_trigger": "2"}
    reader = feed_source.FeedStreamReader(options)
    assert [reader.latestOffset()["entries"] for _ in range(4)] == [1, 2, 3, 4] and len(lists) == 1
    (tmp_path / "late.csv").write_text("a\n2\n")
    assert reader.latestOffset()["entries"] == 5 and len(lists) == 2 and reader.latestOffset()["entries"] == 5
    # A restart goes on behind the log.
    assert feed_source.FeedStreamReader(options).latestOffset()["entries"] == 5
    names = [f["path"].rsplit("/", 1)[-1] for n in range(1, 6) for f in reader._entry(n)]
    assert sorted(names) == sorted([*(f"{i}.csv" for i in range(7)), "late.csv"])


def test_bytes_are_dealt_over_the_cores():
    found = [feed_source.Found("a", "b", 100 << 20, 0)]
    assert len(feed_source.deal(found, feed_source.share(found, feed_source.RANGE, 8))) == 8
    assert feed_source.share(found, feed_source.RANGE, 1) == feed_source.RANGE and feed_source.share([], feed_source.RANGE, 8) == feed_source.BLOCK


def test_json_gzip_quotes_and_too_wide_headers(spark, tmp_path):
    import gzip

    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"ping_id": 5, "speed_kmh": "x", "other": 1}\nnot json\n')
    rows = landing.read_feed(spark, f"{tmp_path}/j", "json", SHORT, text=True)
    assert sorted(map(tuple, rows.select("ping_id", "speed_kmh", "batch_id").collect()), key=str) == [("5", "x", None), (None, None, None)]
    (tmp_path / "c").mkdir()
    with gzip.open(tmp_path / "c" / "a.csv.gz", "wt") as file:
        file.write('ping_id,"batch_id",ping_id\n"a, b",,second\n"say \\"hi\\"",x\n')
    rows = landing.read_feed(spark, f"{tmp_path}/c", "csv", SHORT, text=True)
    assert sorted(map(tuple, rows.select("ping_id", "batch_id").collect()), key=str) == [("a, b", None), ('say "hi"', "x")]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text(",".join(f"n{i}" for i in range(90)) + "\n1,2\n")
    with pytest.raises(Exception, match="too many columns"):
        landing.read_feed(spark, f"{tmp_path}/w", "csv", SHORT, text=True).collect()
    assert landing.read_feed(spark, f"{tmp_path}/none", "csv", SHORT, text=True).count() == 0


def test_a_changed_row_rewrites_one_range(spark):
    from quarrylens.sources import copies

    sinks.ensure_db(spark, "t_copies")
    rows = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"), F.lit(None).cast("int").alias("w"))
    rows = rows.unionAll(rows.where("k = 5")).union(spark.createDataFrame([(None, "n", 1)], "k bigint, v string, w int"))
    refresh = lambda df: copies.refresh_copy(spark, df, "t_copies.c", ["k"], 16)
    same = lambda df: df.exceptAll(copies.copied(spark, "t_copies.c")).count() == 0 == copies.copied(spark, "t_copies.c").exceptAll(df).count()
    assert len(refresh(rows)) == 16 and same(rows)
    assert refresh(rows.repartition(7)) == []
    changed = rows.withColumn("v", F.when(F.col("k") == 9, F.lit("x")).otherwise(F.col("v")))
    assert len(refresh(changed)) == 1 and same(changed)
    # A NULL that moves to another column, a copy less of a repeated row, a range that goes empty.
    moved = changed.withColumn("w", F.when(F.col("k") == 6, F.lit(6)).otherwise(F.col("w")))
    assert len(refresh(moved)) == 1 and same(moved)
    assert len(refresh(moved.distinct())) == 1 and same(moved.distinct())
    few = moved.where("k = 9")
    assert len(refresh(few)) == 16 and same(few)
    with pytest.raises(ValueError):
        refresh(few.drop("w"))


def test_landed_receipts_are_packed_and_dealt_to_files(spark, tables, tmp_path, monkeypatch):
    from quarrylens.plans import operator_queries

    monkeypatch.setattr(operator_queries, "work_dir", lambda *_: str(tmp_path))
    monkeypatch.setattr(operator_queries, "derived_tables", lambda *_: tables)
    monkeypatch.setitem(operator_queries.PACKED_LINES, "maxRecordsPerFile", 500)
    out = operator_queries.STREAMS["a3_json_feed"](spark, "").collect()
    landed = [f.name for f in (tmp_path / "landing").rglob("*/part-*")]
    rows = tables["bronze_delivery_receipts"].count()
    assert len(landed) >= rows // 500 and all(n.endswith(".json.gz") for n in landed)
    assert sum(r.receipts for r in out) == rows
