"""Embeddings, URLs, archives, linked groups and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from llm.data import DOC_SCHEMA, doc, frame
from llm.test_text_operators import brute_contamination, brute_groups, brute_prints, labelled
from quarrylens.llm import embeddings, lines, quality, url_filter, warc
from quarrylens.llm.common import components, stored
from quarrylens.llm.queries import ORACLES, QUERIES, RULES
from quarrylens.session import work_dir

SF = "/root/testdata/sf0.001"


def test_components_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 300), (2, 1)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "t")
    got = {r.id: r.component_id for r in found.collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, **{200 + i: 100 for i in range(50)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "t").count() == 0


# --- 2: embeddings ---


def vectors(dims=64):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        rows.append((i, rng.normal(size=dims).tolist(), i % 3))
    for i in range(60):
        near = np.array(rows[i % 5][1]) + rng.normal(size=dims) * 0.35 * rng.random()
        rows.append((200 + i, near.tolist(), rows[i % 5][2]))
    rows += [(300 + i, rows[4][1], rows[4][2]) for i in range(20)] + [(330, rows[4][1], None), (331, None, 1), (332, [], 1)]
    rows += [(333, [0.0] * dims, 1), (334, [math.nan] + [1.0] * (dims - 1), 1), (335, [math.inf] + [1.0] * (dims - 1), 1)]
    rows += [(336, [None] + [1.0] * (dims - 1), 1), (337, [1.0] * 5, 1), (338, [2.0] * 5, 1), (None, rows[4][1], rows[4][2])]
    rows += [(339, (np.array(rows[4][1]) * 7).tolist(), rows[4][2])]
    return rows


def brute_links(rows, cosine=0.93):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    use = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and lab is not None and good(v)]
    unit = {i: (v / np.linalg.norm(v), lab) for i, v, lab in use}

    def linked(a, b):
        x, y = unit.get(a), unit.get(b)
        return a != b and x and y and x[1] == y[1] and len(x[0]) == len(y[0]) and float(x[0] @ y[0]) >= cosine

    keys = [r[0] for r in rows if r[0] is not None]
    root = brute_groups(keys, linked)
    return {k: (sum(bool(linked(k, o)) for o in keys), root[k], root[k] == k) for k in keys}


def test_embeddings(spark, monkeypatch):
    schema = "vec_id bigint, embedding array<double>, label int, node string, x string"
    rows = vectors()
    table = spark.createDataFrame([(*r, "n", "x") for r in rows], schema)
    expect = brute_links(rows)
    for tile in (2048, 8):
        monkeypatch.setattr(embeddings, "TILE_ROWS", tile)
        out = embeddings.embedding_components(table).collect()
        assert len(out) == len(rows)
        assert {r.vec_id: tuple(r)[1:] for r in out if r.vec_id is not None} == expect
    assert embeddings.embedding_components(table.limit(0)).count() == 0


def test_embeddings_are_searched_few_blocks_at_a_time(spark, monkeypatch):
    rows = [r for r in vectors() if r[1] and None not in r[1]]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    single = [(i, np.array(v, np.float32).astype(float).tolist(), label) for i, v, label in rows]
    widths = []
    keep = embeddings.stored
    monkeypatch.setattr(embeddings, "SHUFFLED", 1)
    monkeypatch.setattr(embeddings, "TILE_ROWS", 64)
    monkeypatch.setattr(embeddings, "stored", lambda df, label: (widths.append((label, df.dtypes)), keep(df, label))[1])
    found = embeddings.embedding_components(table).where("vec_id IS NOT NULL").collect()
    assert {r.vec_id: tuple(r)[1:] for r in found} == brute_links(single)
    assert sum(label == "embedding-links" for label, _ in widths) == 8
    assert ("vector", "array<float>") in dict(widths)["embedding-nodes"]


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {every.apply(i).getName() for i in range(every.size()) if every.apply(i).getName().startswith("shuffle_")}

    before = files()
    rows = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "groups")
    left = lambda: [name for name in files() - before if name.endswith(".data")]
    for _ in range(50):
        # They are removed beside the run.
        if not left():
            break
        time.sleep(0.1)
    assert not left()
    assert rows.count() == 7


# --- 4: URLs ---


def test_hosts_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/Page?q#f": ("www.example.com", "/en/Page", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "x://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"),
        "x://b.net?/es/": ("b.net", "", None, None),
        "http://a.com": ("a.com", "", None, None),
        "no scheme/at://all.net/fr/x": ("all.net", "/fr/x", "net/fr/", "block"),
        "plain": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://\u00c9A.org/\n": ("\u00c9a.org", "/\n", None, None),
    }
    rows = [(i, u) for i, u in enumerate(cases)]
    table = spark.createDataFrame(rows + rows[:1] + [(None, "http://c.com/")], "page_id bigint, url string").selectExpr("*", "'z' AS host", "'z' AS rule")
    out = url_filter.judge(table, RULES).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        if r.page_id is not None:
            host, path, rule, verdict = cases[rows[r.page_id][1]]
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == (verdict or ("block" if r.block_score > 0.5 else "allow"))
    assert url_filter.judge(table.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(table, []).collect()} == {"allow"}


def test_url_model_generalises(spark):
    rng = np.random.default_rng(1)
    known = [(f"{rng.choice(['ads', 'track'])}{i}.io" if i % 2 else f"news{i}.org", f"/p/{i}", "block" if i % 2 else "allow") for i in range(400)]
    table = spark.createDataFrame([(i, f"http://{h}/q/{i}") for i, (h, _, _) in enumerate(known)], "page_id bigint, url string")
    labelled = spark.createDataFrame([k for i, k in enumerate(known) if i % 4 < 2], "host string, path string, verdict string")
    out = url_filter.judge(table, [], labelled).collect()
    assert np.mean([r.verdict == known[r.page_id][2] for r in out if r.page_id % 4 >= 2]) > 0.95


# --- 8: WARC ---


def pages(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"http://h/{i}", "".join(chr(rng.integers(32, 900)) for _ in range(int(rng.integers(0, 4000))))) for i in range(60)]
    rows += [(100 + i, "http://copy", rows[5][2]) for i in range(9)] + [(120, None, None), (121, "a b\r\nX: y", ""), (122, "u", "x\r\n\r\nWARC/1.1\r\n" * 500)]
    rows += [(123, "big", "long " * 400_000), rows[5], (None, "none", "null id")]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'p' AS payload", "'i' AS id")


def test_archives(spark):
    rows, table = pages(spark)
    path = work_dir(spark, "warc-test")
    warc.write_archives(table.repartition(3), path)
    firsts = {}
    for key, _, html in rows:
        if key is not None:
            firsts[html or ""] = min(key, firsts.get(html or "", key))
    expect = Counter()
    for key, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html or "", key)
        other = key is not None and first != key
        name = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expect[(key and str(key) if key is not None else None, len(raw), name, "revisit" if other else "response", str(first) if other else None)] += 1
    for split in (1 << 10, 77_777, 8 << 20):
        out = warc.read_archives(spark, path, split).select(
            warc.page_of("record_id").alias("k"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("r"), "payload"
        ).collect()
        got = Counter(("0" if r.k == "0" else r.k, *tuple(r)[1:5]) for r in out)
        assert got == Counter({("0" if k[0] == 0 else k[0], *k[1:]): n for k, n in expect.items()})
        assert all(hashlib.sha1(r.payload).digest() == base64.b32decode(r.payload_digest) for r in out if r.record_type == "response")
    # Every range is a task of its own, also under adaptive execution.
    cut = warc.read_archives(spark, path, 10_000, payloads=False).withColumn("task", F.spark_partition_id())
    assert cut.select("task").distinct().count() > 3
    # Any gzip reader can read the files.
    file = next(p for p in Path(path.removeprefix("file:")).glob("part-*") if p.stat().st_size)
    assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")
    empty = work_dir(spark, "warc-empty")
    warc.write_archives(table.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_false_magic_is_no_member():
    def pack(content):
        tool = zlib.compressobj(0, zlib.DEFLATED, 31)
        return tool.compress(content) + tool.flush()

    inner = gzip.compress(b"no archive") + warc.MAGIC + b"junk"
    block = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n"
    data = b"".join(pack(block) for _ in range(5)) + warc.SEPARATOR + pack(block)
    for split in (7, 50, len(data)):
        found = []
        for at in range(0, len(data), split):
            found += warc.members(warc.Buffered(io.BytesIO(data)), at, min(at + split, len(data)))
        assert found == [block] * 6


# --- registry and pipeline ---


def test_registered():
    numbers = {int(k[2:].split("_")[0]) for k in QUERIES}
    assert numbers == set(range(1, 11)) and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for key, sql in ORACLES.items():
        out = QUERIES[key](spark, SF)
        columns = sorted(out.columns)
        mine = sorted(map(repr, (tuple(r[c] for c in columns) for r in out.collect())))
        theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert mine == sorted(map(repr, theirs)), key


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_filter", "line_dedup", "near_dedup", "decontamination", "packing"]
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        n = out.count()
        assert 0 < n <= seen and (name != "line_dedup" or n == seen)
        docs, seen = out, n
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == seen


def planted(spark):
    """Good and bad documents, near copies, a menu line per source, passages of the benchmark."""
    rng = random.Random(3)
    base = [tuple(r) for r in labelled(spark, 400)[0].collect()]
    quiet = [f"{w}{n}" for w in ("river", "stone", "green", "house", "walks") for n in range(60)]
    passage = lambda n: " ".join(rng.choice(quiet) for _ in range(n))
    rows = [doc(i, r[1], f"s{i % 4}") for i, r in enumerate(base)]
    rows += [doc(1000 + i, f"Menu | home\n{passage(40)}\nContact us", "s1") for i in range(30)]
    rows += [doc(1100 + i, f"{passage(30)}\nonly thrice {i % 40}", "s2") for i in range(60)]
    long = passage(300)
    rows += [doc(1200 + i, long + f" end{i}" * (i % 3), "s3") for i in range(25)]
    rows += [doc(1240 + i, long, None) for i in range(3)]
    items = [(f"q{i}", passage(25)) for i in range(6)] + [("short", passage(6)), ("none", None)]
    rows += [doc(1300 + i, f"{passage(50)} {items[i % 7][1]} {passage(50)}", f"s{i % 3}") for i in range(20)]
    rows += [doc(1400, passage(6000)), doc(1401, None), doc(1402, "")]
    return rows, items


def brute_pipeline(rows, items, is_good):
    """The stages up to packing, over (doc_id, text, source)."""
    docs = [r for r in rows if is_good(r)]
    pages, on = Counter(r[2] for r in docs), Counter()
    for _, text, source in docs:
        on.update({(source, line.strip(" ")) for line in (text or "").split("\n") if line.strip(" ")})
    gone = {key for key, n in on.items() if n >= lines.MIN_PAGES and n > lines.RATIO * pages[key[0]]}
    short = lambda text, source: "\n".join(x for x in text.split("\n") if (source, x.strip(" ")) not in gone)
    docs = [(k, text if text is None else short(text, source)) for k, text, source in docs]
    prints = {k: brute_prints(text) for k, text in docs}
    root = brute_groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    docs = [(k, text) for k, text in docs if root[k] == k]
    hit = brute_contamination([(k, text or "") for k, text in docs], items)
    return [(k, text) for k, text in docs if not hit[k][4]], len(gone), sum(v[4] for v in hit.values())


def test_pipeline_against_brute_force(spark, tmp_path):
    rows, items = planted(spark)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    good = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] >= 1000], "doc_id bigint, quality int, toxic int")
    labelled(spark, 400)[1].unionByName(good).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "labels"))
    scored = {r.doc_id: r.score >= 0.3 for r in quality.classify(docs, labels).collect()}
    kept, n_lines, n_hit = brute_pipeline([(r[0], r[1], r[3]) for r in rows], items, lambda r: scored[r[0]])
    assert 100 < len(kept) < sum(scored.values()) < len(rows) and n_lines >= 2 and n_hit >= 15
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expect = Counter()
    for key, text in kept:
        ids = np.array([*tokens.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 4096):
            piece = ids[at : at + 4096]
            expect[(key, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == expect


def test_pipeline_stages_on_edge_rows(spark):
    rows = frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, rows, SF).columns == rows.columns
        assert stage(spark, frame(spark, []), SF).count() == 0
    assert spark.createDataFrame([doc(1, "a")], DOC_SCHEMA).count() == 1
