"""Streams against the batch answer on small files."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrylens.operators.evaluate import execution_match
from quarrylens.operators.latest import dedup_latest
from quarrylens.plans import gold
from quarrylens.sources import files, schemas
from quarrylens.streaming import jobs, products
from quarrylens.streaming.keyed import KeyedTable
from quarrylens.streaming.latest_state import newest_rows

SCHEMA = schemas.schema("k string, v int, at timestamp")


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, "k string, v int, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(f"{folder}")


def test_ingest_takes_each_file_once(spark, tmp_path):
    feed = tmp_path / "landing" / "b1" / "feed"
    feed.mkdir(parents=True)
    (feed / "a.csv").write_text("k,v,at\nx,1,2025-01-01 00:00:00\n")
    run = lambda: jobs.run_to_end(
        jobs.stream_ingest(spark, str(tmp_path / "landing"), "feed", "csv", SCHEMA, str(tmp_path / "out"), str(tmp_path / "ckpt"), datetime(2025, 1, 3))
    )
    run()
    run()
    later = tmp_path / "landing" / "b2" / "feed"
    later.mkdir(parents=True)
    (later / "a.csv").write_text("k,v,at\ny,2,2025-01-02 00:00:00\n")
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in rows] == [("x", 1), ("y", 2)]
    assert rows[1]["_source_file"].endswith("b2/feed/a.csv")


def test_upsert_latest(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "table", "ckpt"))
    batches = [
        [("a", 1, "2025-01-01 00:00:00"), ("a", 2, "2025-01-02 00:00:00"), ("b", 1, "2025-01-01 00:00:00")],
        [("a", 3, "2024-12-31 00:00:00"), ("b", 9, "2025-01-05 00:00:00"), ("c", 4, "2025-01-01 00:00:00")],
    ]
    for rows in batches:
        put(spark, src, "x", rows)
        stream = jobs.read_stream(spark, src, "parquet", SCHEMA)
        query, table = jobs.stream_upsert_latest(stream, path, ["k"], ["at", "v"], ckpt)
        jobs.run_to_end(query)
    assert {r["k"]: r["v"] for r in table.read().collect()} == {"a": 2, "b": 9, "c": 4}


KEYED = schemas.schema("k string, v int")


def keyed(spark, path, **more):
    return KeyedTable(spark, str(path), KEYED, ("k",), ("v",), buckets=1, **more)


def contents(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_fifty_batches_stay_few_files(spark, tmp_path):
    table, want = keyed(spark, tmp_path / "t"), {}
    for i in range(50):
        rows = [("hot", i), (f"k{i % 7}", 100 - i), (None, i)]
        for k, v in rows:
            want[k] = max(v, want.get(k, v))
        table.append(spark.createDataFrame(rows, KEYED), i)
    # 50 is 302 in base 4: three segments of sixteen batches, none of four, two of one.
    assert [s.level for s in table.manifest().segments].count(2) == 3 and len(table.manifest().segments) == 5
    assert len(table.read().inputFiles()) <= 9
    assert len(files.names(spark, f"{table.path}/segments")) <= 3 * table.keep
    assert contents(table.read()) == want
    # A batch that is delivered again changes nothing.
    table.append(spark.createDataFrame([("hot", 1000)], KEYED), 49)
    assert contents(table.read()) == want


def test_crash_between_fold_and_switch(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path / "t", fan=2)
    put_one = lambda i: table.append(spark.createDataFrame([("a", i), (f"k{i}", i)], KEYED), i)
    put_one(0)
    commit = KeyedTable._commit

    def lost(self, new):
        if any(s.level for s in new.segments):
            raise OSError("lost")
        return commit(self, new)

    monkeypatch.setattr(KeyedTable, "_commit", lost)
    with pytest.raises(OSError):
        put_one(1)
    # The folded segment is there, the manifest does not name it: readers see both batches.
    assert contents(table.read()) == {"a": 1, "k0": 0, "k1": 1}
    monkeypatch.undo()
    put_one(1)
    put_one(2)
    assert contents(table.read()) == {"a": 2, "k0": 0, "k1": 1, "k2": 2}
    assert [s.level for s in table.manifest().segments] == [1, 0]


def test_manifest_is_never_replaced(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    table.append(spark.createDataFrame([("a", 1)], KEYED), 0)
    with pytest.raises(Exception, match="exists"):
        files.put_new(spark, table._manifest_path(1), "{}", str(tmp_path / "draft"))
    # A reader that began earlier still finds its version.
    before = table.manifest()
    table.append(spark.createDataFrame([("a", 2)], KEYED), 1)
    assert contents(table.read(upto=0)) == {"a": 1} and table.manifest(upto=0) == before


def test_sums_and_lookup(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KEYED, ("k",), sums=("v",), fan=2)
    for i, rows in enumerate(([("a", 1), ("b", 2), (None, 3)], [("a", 4), ("b", -2)], [("a", -1), (None, 1)])):
        table.append(spark.createDataFrame(rows, KEYED), i)
    assert contents(table.read()) == {"a": 4, None: 4}
    assert contents(table.lookup(spark.createDataFrame([(None,), ("b",)], "k string"))) == {None: 4}


def test_watermark_drops_late_rows(spark, tmp_path):
    src, log, ckpt = (str(tmp_path / n) for n in ("src", "log", "ckpt"))
    daily = lambda s: (
        s.withWatermark("at", "1 hour").groupBy(F.window("at", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.start").alias("day"), "n")
    )
    for rows in (
        [("a", 1, "2025-01-01 10:00:00"), ("a", 1, "2025-01-01 11:00:00")],
        [("a", 1, "2025-01-05 00:00:00")],
        [("late", 1, "2025-01-01 12:00:00"), ("sentinel", 1, "2025-01-09 00:00:00")],
    ):
        put(spark, src, "x", rows)
        jobs.run_to_end(jobs.write_log(daily(jobs.read_stream(spark, src, "parquet", SCHEMA)), log, ckpt))
    closed = {str(r["day"]): r["n"] for r in jobs.read_log(spark, log).collect()}
    assert closed["2025-01-01"] == 2 and closed["2025-01-05"] == 1


def delivery_parts(tables):
    """Final rows, and the same with some of them in an earlier, wrong version; some values are NULL."""
    rows = tables["silver_deliveries"].select(products.ID, *products.COUNTED, F.lit(2).alias("version"))
    some = lambda n: F.pmod(F.xxhash64(products.ID), F.lit(n)) == 0
    rows = rows.withColumns(
        {
            "total_cost": F.when(~some(5), F.col("total_cost")),
            "material": F.when(~some(11), F.col("material")),
            "supplier": F.when(~some(13), F.col("supplier")),
        }
    )
    wrong = rows.where(some(3)).withColumns(
        {"version": F.lit(1), "total_cost": F.lit(1e6), "material": F.lit("gone"), "supplier": F.lit("nobody"), "is_damaged": ~F.col("is_damaged")}
    )
    return rows, rows.where(~some(3)).unionByName(wrong), rows.where(some(3))


def test_incremental_product_with_repeats_and_corrections(spark, tables, tmp_path):
    rows, first, corrections = delivery_parts(tables)
    product = products.DeliveryPerformance(spark, str(tmp_path / "mv"), rows.schema, ["version"], buckets=2)
    src = str(tmp_path / "src")
    for part in (first, corrections, first):
        part.coalesce(2).write.mode("append").parquet(src)
        stream = jobs.read_stream(spark, src, "parquet", rows.schema, files_per_trigger=1)
        jobs.run_to_end(product.refresh(stream, str(tmp_path / "ckpt")))
    assert execution_match(product.read(), gold.delivery_performance(rows)).first()["is_match"]
    assert not product.read().where("supplier = 'nobody'").count()


def test_incremental_product_survives_a_crash_between_its_tables(spark, tables, tmp_path, monkeypatch):
    rows, first, corrections = delivery_parts(tables)
    product = products.DeliveryPerformance(spark, str(tmp_path / "mv"), rows.schema, ["version"], buckets=2)
    product.apply(first, 0)
    append = KeyedTable.append

    def lost(self, batch, batch_id):
        if self.path.endswith("members"):
            raise OSError("lost")
        append(self, batch, batch_id)

    monkeypatch.setattr(KeyedTable, "append", lost)
    with pytest.raises(OSError):
        product.apply(corrections, 1)
    # The sums are a batch ahead; readers stay at the last batch that every table has.
    assert execution_match(product.read(), gold.delivery_performance(first)).first()["is_match"]
    monkeypatch.undo()
    product.apply(corrections, 1)
    product.apply(corrections, 1)
    assert execution_match(product.read(), gold.delivery_performance(rows)).first()["is_match"]


@pytest.mark.parametrize("kind", ["string", "bigint", "double", "date", "boolean"])
def test_lookup_window_and_join_share_their_exchanges(spark, tmp_path, kind):
    values = {"string": "''", "bigint": "0", "double": "0.0", "date": "'1970-01-01'", "boolean": "false"}
    rows = spark.sql(f"SELECT cast(k AS {kind}) AS k, v FROM VALUES ({values[kind]}, 1), (NULL, 2) AS t(k, v)")
    table = KeyedTable(spark, str(tmp_path), rows.schema, ("k",), ("v",), buckets=2)
    table.append(rows, 0)
    # A NULL key is not taken for the value that stands for it.
    assert [r["v"] for r in table.lookup(rows.where("k IS NULL")).collect()] == [2]
    assert [r["v"] for r in table.lookup(rows.where("v = 1")).collect()] == [1]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        new = table.dealt_by(rows)
        both = dedup_latest(new, table.by, ["v"]).select(*table.by, F.col("v").alias("now")).join(table.found(new), table.by, "left")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["now"], r["v"]) for r in both.collect()) == [(1, 1), (2, 2)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # The batch, what is stored, and the keys asked for; numbers that joins make plain first are dealt once more.
    assert plan.count("Exchange hashpartitioning") == (4 if kind == "double" else 3)


def test_a_batch_that_all_tables_have_leaves_no_log_and_no_shuffle_files(spark, tables, tmp_path):
    def shuffled():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = {every.apply(i).getName() for i in range(every.size())}
        return {name for name in found if name.startswith("shuffle_") and name.endswith(".data")}

    rows, first, corrections = delivery_parts(tables)
    parts = []
    for n, part in enumerate((first, corrections)):
        part.write.parquet(str(tmp_path / f"p{n}"))
        parts.append(spark.read.schema(part.schema).parquet(str(tmp_path / f"p{n}")))
    product = products.DeliveryPerformance(spark, str(tmp_path / "mv"), rows.schema, ["version"], buckets=2)
    before = shuffled()
    for n, part in enumerate(parts):
        product.apply(part, n)
        assert not files.names(spark, str(tmp_path / "mv" / "deltas"))
    for _ in range(50):
        # They are removed beside the run.
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert execution_match(product.read(), gold.delivery_performance(rows)).first()["is_match"]


def test_newest_state_with_late_rows_and_restart(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "t", "ckpt"))
    for rows in (
        [("a", 1, "2025-01-02 00:00:00"), ("a", 2, None), ("b", 1, "2025-01-01 00:00:00")],
        [("a", 3, "2025-01-01 00:00:00"), ("b", None, "2025-01-01 00:00:00"), ("c", 7, None)],
        [("b", 4, "2025-01-01 00:00:00"), ("c", 6, None)],
    ):
        put(spark, src, "x", rows)
        # Each run is a restart: the state comes from the checkpoint.
        query, table = jobs.stream_latest(jobs.read_stream(spark, src, "parquet", SCHEMA), path, ["k"], ["at", "v"], ckpt, buckets=1)
        jobs.run_to_end(query)
    assert contents(table.read()) == {"a": 1, "b": 4, "c": 7}
    assert str(table.read().where("k = 'a'").first()["at"]) == "2025-01-02 00:00:00"


def test_newest_state_in_a_session_with_another_state_store(spark, tmp_path):
    """Spark's default store has no operator state; the session's own setting is left as it was."""
    plain, provider = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain.conf.set(provider, other)
    src = str(tmp_path / "src")
    put(spark, src, "x", [("a", 1, "2025-01-02 00:00:00"), ("a", 2, None), ("b", 1, None)])
    source = jobs.read_stream(plain, src, "parquet", SCHEMA)
    query, table = jobs.stream_latest(source, str(tmp_path / "t"), ["k"], ["at", "v"], str(tmp_path / "ckpt"), buckets=1)
    jobs.run_to_end(query)
    assert contents(table.read()) == {"a": 1, "b": 1}
    assert plain.conf.get(provider) == other


def test_silent_keys_are_forgotten(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "t", "ckpt"))
    seen = []
    for rows in (
        [("a", 1, "2025-01-01 00:00:00"), ("b", 1, "2025-01-01 00:00:00")],
        [("b", 2, "2025-01-20 00:00:00")],
        # The watermark has passed a's timer: its state is gone, so the older row counts as new.
        [("a", 0, "2025-01-19 12:00:00"), ("b", 1, "2025-01-19 12:00:00")],
    ):
        put(spark, src, "x", rows)
        stream = jobs.read_stream(spark, src, "parquet", SCHEMA)
        changes = newest_rows(stream, ["k"], ["v"], "at", "1 day", timedelta(days=5))
        jobs.run_to_end(jobs.write_log(changes, path, ckpt, "update", lambda b: b))
    for r in jobs.read_log(spark, path).orderBy("_batch", "k").collect():
        seen.append((r["k"], r["v"]))
    assert seen == [("a", 1), ("b", 1), ("b", 2), ("a", 0)]
    with pytest.raises(ValueError):
        newest_rows(stream, ["k"], ["v"], None, None, timedelta(days=5))


def test_dedup_within_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, src, "x", [("a", 1, "2025-01-01 00:00:00"), ("a", 2, "2025-01-01 00:10:00"), ("b", 1, "2025-01-01 00:00:00")])
    out = jobs.stream_dedup(jobs.read_stream(spark, src, "parquet", SCHEMA), ["k"], "at", "1 hour")
    jobs.run_to_end(jobs.write_log(out, str(tmp_path / "log"), str(tmp_path / "ckpt")))
    assert sorted(r["k"] for r in jobs.read_log(spark, str(tmp_path / "log")).collect()) == ["a", "b"]


def test_failed_stream_is_reported(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, src, "x", [("a", 1, "2025-01-01 00:00:00")])
    stream = jobs.read_stream(spark, src, "parquet", SCHEMA)
    broken = lambda batch: batch.select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        jobs.run_to_end(jobs.write_log(stream, str(tmp_path / "log"), str(tmp_path / "ckpt"), shape=broken))


@pytest.mark.parametrize("key, name, column", [("b6_refreshed_copy", "silver_invoices", "invoice_id"), ("j8_stream_refresh_mv", "silver_deliveries", "delivery_id")])
def test_input_is_computed_once(spark, tables, monkeypatch, key, name, column):
    from quarrylens.plans import operator_queries

    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    rows = tables[name].limit(300)
    looked = rows.withColumn(column, F.udf(look, "string").asNondeterministic()(column))
    monkeypatch.setattr(operator_queries, "derived_tables", lambda *_: {name: looked})
    operator_queries.STREAMS[key](spark, "").count()
    assert seen.value == rows.count()


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    sizes = [f"spark.sql.adaptive.{name}" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    before = [spark.conf.get(size) for size in sizes]
    for size in sizes:
        spark.conf.set(size, "10k")
    try:
        table = keyed(spark, tmp_path / "t")
        rows = spark.range(20000).selectExpr("cast(id as string) k", "cast(id as int) v").repartition(8)
        table.append(rows, 0)
    finally:
        for size, value in zip(sizes, before):
            spark.conf.set(size, value)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) > 1
    assert table.read().count() == 20000 == table.lookup(rows.select("k")).count()
