"""Joins, windows, comparison and retrieval against brute force on small random rows."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylens.functions import aggs
from quarrylens.operators import joins, retrieval, windows
from quarrylens.operators.evaluate import eval_rollup, execution_match
from quarrylens.operators.keyword_index import KeywordIndex
from quarrylens.operators.latest import latest_snapshot, latest_with_ties
from quarrylens.operators.rights import RightsIndex
from quarrylens.operators.vector_index import VectorIndex

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.integers(0, 6)


@FEW
@given(st.lists(small, min_size=1, max_size=60))
@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("desc", [True, False])
def test_ranked_equals_sorting(spark, dense, desc, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["rank"] for r in windows.ranked(df, "v", desc=desc, buckets=4, dense=dense).collect()}
    for i, v in enumerate(values):
        better = [w for w in values if (w > v if desc else w < v)]
        assert got[i] == (len(set(better)) if dense else len(better)) + 1


@FEW
@given(st.lists(st.tuples(small, small), max_size=30), st.lists(st.tuples(small, small), max_size=30))
def test_fan_out_equals_row_level_join(spark, left, right):
    a = spark.createDataFrame(left, "k int, x int")
    b = spark.createDataFrame(right, "k int, y int")
    row_level = a.join(b, "k", "left").groupBy("k").agg(aggs.n_rows().alias("pairs"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    ga = a.groupBy("k").agg(aggs.n_rows().alias("_rows_a"), F.sum("x").alias("x"))
    gb = b.groupBy("k").agg(aggs.n_rows().alias("_rows_b"), F.sum("y").alias("y"))
    short = joins.fan_out(ga, gb, ["k"]).select(
        "k", F.col("_pairs").alias("pairs"), (F.col("x") * F.col("_times_a")).alias("sx"), (F.col("y") * F.col("_times_b")).alias("sy")
    )
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, row_level.collect()))


def test_fan_out_never_pairs_rows(spark):
    a = spark.range(1000).select((F.col("id") % 2).alias("k"))
    plan = joins.fan_out(a.groupBy("k").agg(aggs.n_rows().alias("_rows_a")), a.groupBy("k").agg(aggs.n_rows().alias("_rows_b")), ["k"])
    assert [r["_pairs"] for r in plan.collect()] == [250_000, 250_000]


def test_ties_survive_and_nulls_do_not(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 2, 2), ("a", 1, 3), ("b", None, 4), (None, 5, 5)], "k string, t int, v int")
    assert sorted(r["v"] for r in latest_with_ties(df, ["k"], "t").collect()) == [1, 2]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 3)], "v int, reporting_period int")
    assert sorted(r["v"] for r in latest_snapshot(df).collect()) == [2, 3]


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 10.0), ("y", 5.0)], "k string, m double")
    b = spark.createDataFrame([("x", 10.4), ("z", 1.0)], "k string, m double")
    got = {r["k"]: (r["difference"], r["is_aligned"]) for r in joins.reconcile(a, b, ["k"], ["m"], 0.5).collect()}
    assert got["x"][1] and got["y"] == (5.0, False) and got["z"] == (-1.0, False)


def test_reconcile_counts_a_missing_side_as_unaligned(spark):
    a = spark.createDataFrame([("x", 0.1)], "k string, m double")
    b = spark.createDataFrame([("z", 0.1)], "k string, m double")
    assert not any(r["is_aligned"] for r in joins.reconcile(a, b, ["k"], ["m"], 0.5).collect())


@FEW
@given(st.lists(st.tuples(small, st.sampled_from("ab")), max_size=25), st.lists(st.tuples(small, st.sampled_from("ab")), max_size=25))
def test_execution_match_is_multiset_difference(spark, got, want):
    g, w = spark.createDataFrame(got, "a int, b string"), spark.createDataFrame(want, "a int, b string")
    r = execution_match(g.select("b", "a"), w).first()
    cg, cw = Counter(got), Counter(want)
    assert (r["missing_rows"], r["extra_rows"]) == (sum((cw - cg).values()), sum((cg - cw).values()))
    assert r["is_match"] == (cg == cw)


def test_eval_rollup(spark):
    rows = [("r1", "coherence", i < 9) for i in range(10)] + [("r2", "coherence", i < 7) for i in range(10)]
    out = {r["run_id"]: r for r in eval_rollup(spark.createDataFrame(rows, "run_id string, evaluator string, passed boolean")).collect()}
    assert (out["r1"]["pass_rate_pct"], out["r1"]["meets_target"], out["r1"]["is_regression"]) == (90.0, True, False)
    assert (out["r2"]["change_pct"], out["r2"]["meets_target"], out["r2"]["is_regression"]) == (-20.0, False, True)


def test_month_over_month(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 3, 7), ("a", 4, 1)], "k string, m int, v int")
    assert [r["trend"] for r in windows.month_over_month(df, ["k"], "m", "v").orderBy("m").collect()] == [None, "rising", "flat", "falling"]


# --- retrieval --------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "abc", "x" * 10, "héllo wörld " * 9])
def test_chunks_cover_the_whole_text(spark, text):
    out = retrieval.chunk(spark.createDataFrame([(1, text)], "doc_id int, text string"), 10, 3).orderBy("chunk_no").collect()
    rebuilt = ""
    for r in out:
        assert r["start"] <= len(rebuilt)
        rebuilt = rebuilt[: r["start"]] + r["text"]
    assert rebuilt == text


def test_sections(spark):
    df = spark.createDataFrame([(1, "intro\n# One\nbody\n## Two\nmore")], "doc_id int, text string")
    assert [r["text"] for r in retrieval.sections(df).orderBy("section").collect()] == ["intro\n", "# One\nbody\n", "## Two\nmore"]


def bm25(docs, queries, k, k1=1.2, b=0.75):
    words = {i: [w for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()] for i, t in docs.items()}
    known = [ws for i, ws in words.items() if docs[i] is not None]
    avg = sum(map(len, known)) / len(known)
    df = Counter(w for ws in words.values() for w in set(ws))
    out = set()
    for q, terms in queries.items():
        scores = defaultdict(float)
        for i, ws in words.items():
            for term in terms:
                tf = ws.count(term)
                if tf:
                    idf = math.log(1 + (len(words) - df[term] + 0.5) / (df[term] + 0.5))
                    scores[i] += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ws) / avg))
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 4), x[0]))[:k]
        out |= {(q, i, round(s, 4), n) for n, (i, s) in enumerate(best, 1)}
    return out


def test_keyword_topk_equals_brute_force(spark):
    docs = {1: "haul truck brake failure at the pit", 2: "crane brake inspection", 3: "Brake, brake; BRAKE!", 4: "concrete pour", 5: "truck truck crane"}
    queries = {10: ["brake", "truck"], 11: ["crane"], 12: ["absent"]}
    d = spark.createDataFrame(list(docs.items()), "doc_id int, text string")
    q = spark.createDataFrame([(i, w) for i, ws in queries.items() for w in ws], "query_id int, term string")
    got = retrieval.keyword_topk(d, q, 3, ["doc_id"]).collect()
    assert {(r["query_id"], r["doc_id"], round(r["score"], 4), r["rank"]) for r in got} == bm25(docs, queries, 3)


@pytest.mark.parametrize("block", [2, 100])
def test_vector_topk_equals_brute_force(spark, block):
    rng = np.random.default_rng(7)
    data, ask = rng.normal(size=(40, 8)), rng.normal(size=(5, 8))
    emb = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(99, [0.0] * 8)], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(ask)], "query_id int, centre array<double>")
    got = {(r["query_id"], r["vec_id"], r["rank"]) for r in retrieval.vector_topk(emb.repartition(3), q, 4, block=block).collect()}
    sims = (data.astype(np.float32).astype(float) @ ask.T) / np.linalg.norm(data, axis=1)[:, None] / np.linalg.norm(ask, axis=1)
    want = {(j, int(i), n) for j in range(5) for n, i in enumerate(np.argsort(-sims[:, j])[:4], 1)}
    assert got == want


def test_keyword_shards_are_skipped_and_nothing_is_missed(spark):
    """Many small shards, common and rare terms, ties: as brute force, without opening every shard."""
    rng = np.random.default_rng(3)
    common = ["the", "of", "site", "pump", "unit"]
    spelled = lambda n: str(n).translate(str.maketrans("0123456789", "abcdefghij"))
    docs = {i: " ".join([*rng.choice(common, 12), "rare" + spelled(i // 3), "word" + spelled(i % 17)]) for i in range(120)}
    docs[500] = docs[501] = docs[3]
    queries = {1: ["rareb", "the", "of"], 2: ["worde", "pump"], 3: common, 4: ["rareh", "wordc", "site"]}
    d = spark.createDataFrame(list(docs.items()), "doc_id int, text string").union(spark.createDataFrame([(900, ""), (901, None)], "doc_id int, text string"))
    q = spark.createDataFrame([(i, w) for i, ws in queries.items() for w in ws], "query_id int, term string")
    index = KeywordIndex.build(d, ["doc_id"], retrieval.tokens("text"), shard=8)
    assert index.shards.count() >= 15
    opened = []
    scored = KeywordIndex._scored
    index._scored = lambda pairs, *rest: opened.append(pairs.count()) or scored(index, pairs, *rest)
    got = retrieval.keyword_search(index, q, 3).collect()
    # Without words and without text: both are chunks, the latter has no length.
    want = bm25(docs | {900: "", 901: None}, queries, 3)
    assert {(r["query_id"], r["doc_id"], round(r["score"], 4), r["rank"]) for r in got} == want
    assert opened[0] == 4 and sum(opened) < 4 * index.shards.count()
    with_few = retrieval.keyword_topk(d, q, 3, ["doc_id"]).collect()
    assert {(r["query_id"], r["doc_id"], r["rank"]) for r in with_few} == {(a, b, c) for a, b, _, c in want}


def test_vector_clusters_are_skipped_and_nothing_is_missed(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, 16)) * 4
    data = (middles[rng.integers(12, size=600)] + rng.normal(size=(600, 16)) * 0.4).astype(np.float32)
    data[300:320] = data[7]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(900, [0.0] * 16), (901, None), (902, [float("nan")] * 16)]
    emb = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(3)
    queries = emb.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding as centre")
    index = VectorIndex.build(emb, rows=32, sample=200)
    opened = []
    scored = VectorIndex._scored
    index._scored = lambda visits, *rest: opened.append(visits.count()) or scored(index, visits, *rest)
    found = retrieval.top_per_query(index.search(queries, 5, 3), 5, ["vec_id"]).collect()
    units = data.astype(float) / np.linalg.norm(data.astype(float), axis=1)[:, None]
    want = set()
    for j in range(0, 600, 50):
        sims = np.round(units @ units[j], 6)
        want |= {(j, int(i), n) for n, i in enumerate(np.lexsort((np.arange(600), -sims))[:5], 1)}
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in found} == want
    assert opened[0] == 12 and sum(opened) < 12 * len(index.centres) / 2


def test_vector_search_without_vectors(spark):
    none = spark.createDataFrame([], "vec_id int, embedding array<float>")
    ask = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id int, centre array<double>")
    one = spark.createDataFrame([(5, [0.0, 2.0])], "vec_id int, embedding array<float>")
    assert retrieval.vector_topk(none, ask, 3).count() == 0
    assert [tuple(r) for r in retrieval.vector_topk(one, ask, 3).collect()] == [(1, 5, 0.0, 1)]


def test_search_respects_grants_and_filters(spark):
    docs = spark.createDataFrame([(1, "pump seal", "hr", "en"), (2, "pump", "ops", "en"), (3, "pump", "ops", "fr")], "doc_id int, text string, source string, lang string")
    acl = spark.createDataFrame([("ops-team", "ops")], "group_name string, source string")
    members = spark.createDataFrame([("ana", "ops-team")], "principal string, group_name string")
    q = spark.createDataFrame([(1, "pump")], "query_id int, term string")
    find = lambda who: [r["doc_id"] for r in retrieval.search(docs, q, 5, F.col("lang") == "en", acl, members, who).collect()]
    assert find("ana") == [2] and find("bob") == []


ACL = "group_name string, source string"
NUMBERS = st.one_of(st.integers(-70000, 70000), st.sampled_from([0, 1, 32767, 32768, 32769, -32768, 2**40, -(2**40)]))


@FEW
@given(
    st.lists(st.tuples(NUMBERS, st.sampled_from(["a", "b", "c", None])), max_size=40),
    st.lists(st.tuples(st.sampled_from(["g", "h"]), st.sampled_from(["a", "b", "x"])), max_size=4),
    st.lists(st.tuples(st.sampled_from(["ana", "bob"]), st.sampled_from(["g", "h", "none"])), max_size=4),
)
def test_rights_bitmaps_equal_grants(spark, tmp_path_factory, docs, acl, members):
    rows = spark.createDataFrame([*docs, (None, "a")], "doc_id bigint, source string").withColumn("_bits", F.lit("kept"))
    grants, people = spark.createDataFrame(acl, ACL), spark.createDataFrame(members, "principal string, group_name string")
    # A document under two sources is seen by those who are granted either.
    seen = {p: {d for d, s in docs for g, granted in acl if s == granted and (p, g) in members} for p in ("ana", "bob")}
    path = str(tmp_path_factory.mktemp("rights") / "index")
    half = RightsIndex.build(rows.where("doc_id % 2 = 0")).extend(rows.where("doc_id % 2 <> 0 or doc_id is null"))
    half.save(path)
    for index in (RightsIndex.build(rows), RightsIndex.load(spark.read.parquet(path))):
        for p, expect in seen.items():
            kept = index.restrict(rows, p, people, grants)
            assert kept.columns == rows.columns
            assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, _ in docs if d in expect)
        counts = {r["principal"]: r["documents"] for r in index.counts(people, grants).collect()}
        assert counts == {p: len(s) for p, s in seen.items() if s}


def test_rights_change_without_new_bitmaps(spark):
    docs = spark.createDataFrame([(n, "ops" if n % 3 else "hr") for n in range(100)], "doc_id int, source string")
    index = RightsIndex.build(docs)
    people = spark.createDataFrame([("ana", "g")], "principal string, group_name string")
    see = lambda acl: index.restrict(docs, "ana", people, spark.createDataFrame(acl, ACL)).count()
    assert (see([("g", "hr")]), see([("g", "hr"), ("g", "ops")]), see([("h", "hr")])) == (34, 100, 0)
    # Documents meet one row per range, never the grants.
    plan = index.restrict(docs, "ana", people, spark.createDataFrame([("g", "hr")], ACL))._jdf.queryExecution().toString()
    assert "bitmap_or_agg" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rights_are_counted_once_per_set_of_groups(spark):
    docs = spark.createDataFrame([(n, "ops" if n % 3 else "hr") for n in range(100)], "doc_id int, source string")
    members = [(f"p{n}", g) for n in range(30) for g in (("g", "h") if n % 2 else ("g",))] + [("alone", "none"), ("alone", None), (None, "h")]
    people = spark.createDataFrame(members, "principal string, group_name string")
    counts = RightsIndex.build(docs).counts(people, spark.createDataFrame([("g", "hr"), ("h", "ops"), ("h", "hr")], ACL))
    seen = {r["principal"]: r["documents"] for r in counts.collect()}
    assert seen == {f"p{n}": 100 if n % 2 else 34 for n in range(30)} | {None: 100}
    # No bitmap is held per principal.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    united = [line for line in plan.splitlines() if "bitmap_or_agg" in line]
    assert united and not any("principal" in line for line in united)


def test_rank_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, doc_id int, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id int, doc_id int, rank int")
    got = [(r["doc_id"], r["rank"]) for r in retrieval.fuse_ranks(a, b, 3, ["doc_id"]).orderBy("rank").collect()]
    assert got == [(11, 1), (10, 2), (12, 3)]


def test_eval_rollup_by_mean_score(spark):
    rows = [("r1", "coherence", False, 4.5), ("r1", "coherence", True, 3.5), ("r2", "coherence", True, 3.0), ("r1", "violence", True, None)]
    rows += [("r2", "violence", True, None), ("r2", "violence", False, None)]
    scores = spark.createDataFrame(rows, "run_id string, evaluator string, passed boolean, score double")
    out = {(r["run_id"], r["evaluator"]): r["meets_target"] for r in eval_rollup(scores).collect()}
    assert out == {("r1", "coherence"): True, ("r2", "coherence"): False, ("r1", "violence"): True, ("r2", "violence"): False}


def test_partitions_follow_the_stored_input(spark, tmp_path, monkeypatch):
    from quarrylens.operators import partitions

    spark.range(3000).selectExpr("id", "cast(id * 7919 % 3000 as string) s").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    size = partitions.stored_bytes(rows)
    assert size > 0 and partitions.stored_bytes(rows.crossJoin(rows.select(F.col("id").alias("other")))) == 2 * size
    assert partitions.dealt(rows, "id") is rows
    monkeypatch.setattr(partitions, "PER_TASK", size // 20)
    assert partitions.dealt(rows, "id").rdd.getNumPartitions() >= 20
    ordered = partitions.in_order(rows, F.desc("s"), "id")
    assert ordered.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordered.collect() == rows.orderBy(F.desc("s"), "id").collect()


@pytest.mark.parametrize("key", ["q_sf_15", "q_sf_15_safe", "q_pr_12", "q_pr_12_safe"])
def test_large_inputs_give_the_same_rows_in_more_tasks(spark, tables, monkeypatch, key):
    from quarrylens.operators import partitions
    from quarrylens.plans.catalogue import CATALOGUE

    want = CATALOGUE[key](tables).collect()
    monkeypatch.setattr(partitions, "PER_TASK", 1 << 14)
    found = CATALOGUE[key](tables)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert found.collect() == want
