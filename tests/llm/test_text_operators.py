"""Operators over whole texts against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.data import doc, documents, frame
from quarrylens.llm import decontaminate, lines, lm, packing, quality, simhash, suffixes
from quarrylens.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def named(rows):
    return [(r[0], r[1] or "") for r in rows]


# --- 1: decontamination ---


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else []:
            windows[tuple(w[i : i + n])].add(item)
    out = {}
    for key, text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out[key] = (len(w), len(hit), names and names.count(",") + 1 or 0, hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def test_contamination(spark):
    rows = [r for r in documents() if r[0] is not None]
    texts = dict(named(rows))
    items = [
        (1, texts[100][:200]),
        (2, " ".join(texts[7].split()[-12:])),
        (3, "one"),
        (30, "one"),
        (4, None),
        (5, "..."),
        (6, "zeta7 nothing of this kind"),
        (7, " ".join(texts[208].split()[3000:3040])),
        (7, "x" * 3000),
        (8, "\u00fc " * 9),
        (9, "\u00fc " * 10),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.contamination(frame(spark, rows), bench)
    found = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert out.count() == len(rows)
    assert found == brute_contamination(named(rows), items)
    clean = decontaminate.keep_clean(frame(spark, rows), bench)
    assert clean.columns == frame(spark).columns
    assert {r.doc_id for r in clean.collect()} == {k for k, v in found.items() if not v[4]}


def test_contamination_null_ids_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    rows = frame(spark, [doc(None, "Alpha, beta"), doc(None, "no")])
    assert sorted(r.contaminated for r in decontaminate.contamination(rows, bench).collect()) == [True, True]
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0
    rows = [doc(None, "Alpha, beta"), doc(None, "no"), doc(None, None), doc(1, "clean"), doc(1, "alpha beta gamma"), doc(1, "clean")]
    kept = decontaminate.keep_clean(frame(spark, rows), bench).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == [(0, ""), (0, "no"), (1, "clean"), (1, "clean")]
    none = decontaminate.contamination(frame(spark), bench.limit(0)).collect()
    assert len(none) == len(documents()) and not any(r.contaminated for r in none)


def test_contamination_stays_native(spark):
    plan = decontaminate.contamination(frame(spark), frame(spark).withColumnRenamed("doc_id", "item_id"))
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan._jdf.queryExecution().toString())


# --- 3: quality ---


def labelled(spark, n=600):
    rng = np.random.default_rng(5)
    words = ["the", "of", "house", "runs", "green", "quiet", "river", "stone", "walks", "under"]
    rows, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        text = " ".join(rng.choice(words, 60)) + "." if good else "WIN!! NOW!! " * int(rng.integers(5, 60))
        rows.append(doc(i, text))
        labels.append((i, int(good), 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_held_out(spark):
    docs, labels = labelled(spark)
    out = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for k, r in out.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    held = [k for k, r in out.items() if r.held_out]
    assert np.mean([out[k].predicted == truth[k] for k in held]) > 0.97
    # Held-out labels teach nothing.
    flipped = labels.selectExpr("doc_id", "IF(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality")
    again = {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()}
    assert again == {k: r.score for k, r in out.items()}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in out.items() if r.predicted}


def test_quality_pairwise_identity():
    rng = np.random.default_rng(0)
    n = quality.WORD_BUCKETS + quality.STATS
    model = quality.Model(np.zeros(1), np.ones(1), 0.3, rng.normal(size=n), rng.normal(size=(n, 3)))
    x = np.zeros((2, n))
    x[:, rng.choice(n, 12)] = rng.normal(size=12)
    for row, margin in zip(x, model.margin(x)):
        at = np.flatnonzero(row)
        pairs = sum(model.factors[i] @ model.factors[j] * row[i] * row[j] for i in at for j in at if i < j)
        assert margin == pytest.approx(0.3 + row @ model.weights + pairs)


def test_quality_edge_rows(spark):
    docs, labels = labelled(spark, 50)
    out = quality.classify(frame(spark), labels.union(labels.selectExpr("doc_id", "null", "toxic"))).collect()
    assert len(out) == len(documents()) and all(0 <= r.score <= 1 for r in out)
    untaught = quality.classify(frame(spark), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in untaught} == {(0.5, 1)}
    assert quality.classify(frame(spark, []), labels).count() == 0


def test_keep_good_without_length_column(spark):
    docs, labels = labelled(spark)
    bare = docs.drop("n_chars").withColumn("clicks", F.col("doc_id") * 1000)
    good = {r.doc_id for r in quality.classify(bare, labels).collect() if r.predicted}
    for table in (bare, bare.select("clicks", *bare.drop("clicks").columns)):
        kept = quality.keep_good(table, labels)
        assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == good


# --- 5: language model ---


def test_lm_base_counts(spark):
    rows = documents()
    out = lm.score_documents(frame(spark), PATH).collect()
    assert len(out) == len(rows)

    def tokens(text):
        return (text or "").translate(ASCII_LOWER).encode().split() + [b""]

    def is_held(key):
        return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0

    counts = Counter(t for r in rows if not is_held(r[0]) for t in tokens(r[1]))
    total = sum(counts.values())
    scale = total + 0.1 * (len(counts) + 1)
    expect = Counter()
    for r in rows:
        base = sum(math.log10((counts[t] + 0.1) / scale) for t in tokens(r[1]))
        expect[(r[0], is_held(r[0]), len(tokens(r[1])), sum(counts[t] > 0 for t in tokens(r[1])), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expect
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    # Rare words are joined; the result does not depend on how many words tasks hold.
    old, lm.FREQUENT = lm.FREQUENT, 3
    try:
        few = lm.score_documents(frame(spark), PATH).collect()
    finally:
        lm.FREQUENT = old
    assert Counter((r.doc_id, r.n_known, round(r.base_score, 6)) for r in few) == Counter(
        (r.doc_id, r.n_known, round(r.base_score, 6)) for r in out
    )
    assert lm.score_documents(frame(spark, []), PATH).count() == 0


def test_lm_score_mixes_the_share_of_every_known_word(spark):
    rows = [doc(i, "alpha " * 5 + f"beta gamma once{i} \u0301") for i in range(12)] + [doc(50, "\x01 new\x02 alpha once3")]
    want = {r.doc_id: r.score for r in lm.score_documents(frame(spark, rows), PATH).collect()}
    old, lm.FREQUENT = lm.FREQUENT, 3
    try:
        few = {r.doc_id: r.score for r in lm.score_documents(frame(spark, rows), PATH).collect()}
    finally:
        lm.FREQUENT = old
    assert few == pytest.approx(want, abs=1e-6)


def tiny_model(seed=0):
    rng = np.random.default_rng(seed)
    windows = rng.integers(0, 300, (64, lm.WINDOW + 1))
    counts = np.bincount(windows.ravel(), minlength=49408)
    return lm.fit(windows, counts, np.arange(49408) % 2 == 0, passes=1)


def test_lm_probabilities_sum_to_one():
    model = tiny_model()
    assert np.allclose([(10 ** model.within[model.group == g]).sum() for g in range(lm.CLASSES)], 1)
    past = np.array([3, 5, 8])
    whole = [lm.sequence_scores(model, [np.append(past, i)])[-1] for i in range(0, 49408, 997)]
    classes = {}
    for i, s in zip(range(0, 49408, 997), whole):
        classes.setdefault(model.group[i], set()).add(round(s - model.within[i], 4))
    # One class probability per class, and together they are a distribution.
    assert all(len(v) == 1 for v in classes.values())
    every = [np.flatnonzero(model.group == g)[0] for g in range(lm.CLASSES) if (model.group == g).any()]
    total = sum(10 ** (lm.sequence_scores(model, [np.append(past, i)])[-1] - model.within[i]) for i in every)
    assert total == pytest.approx(1, abs=1e-3) or len(every) < lm.CLASSES


def test_lm_tells_common_ids_apart():
    # Each of 200 ids is followed by one other; classes of several ids could not say which.
    order = np.random.default_rng(1).permutation(200)
    cycle = np.tile(order, 20)
    windows = np.stack([cycle[i : i + lm.WINDOW + 1] for i in range(0, 3200, 16)])
    model = lm.fit(windows, np.bincount(cycle, minlength=49408), np.arange(49408) % 2 == 0, passes=1)
    assert lm.sequence_scores(model, [cycle[7:207]])[1:].mean() > -0.3


def test_lm_trains_on_windows_of_all_rows(spark):
    rows = [doc(i, f"only {i} words") for i in range(3300)] + [doc(5000, "long text " * 400)]
    frame_ = frame(spark, rows).selectExpr("doc_id", "cast(text as binary) as body")
    encoded = lm._encoded(frame_, PATH)
    total = encoded.selectExpr("sum(windows)").first()[0]
    found = [np.frombuffer(r.ids, "<i4") for r in lm.training_windows(encoded, 1.0, 4).collect()]
    assert len(found) == total > 3301
    # Short texts and last windows are there, and every id is a target once.
    targets = sum(int((w[lm.WINDOW - lm.STEP + 1 :] >= 0).sum()) for w in found)
    assert targets == encoded.selectExpr("sum(length(ids)) div 4").first()[0]
    half = lm.training_windows(encoded, 0.5, 4).count()
    assert 0.4 * total < half < 0.6 * total
    # The neighbours of all texts are counted.
    assert lm._counted(encoded, lambda line: np.zeros(int((line[1:] >= 0).sum()), np.int64), 1)[0] == targets + len(rows)


def test_lm_fits_on_every_window(spark, monkeypatch):
    rows = frame(spark, [doc(i, f"only {i} words") for i in range(900)]).selectExpr("doc_id", "cast(text as binary) as body")
    seen = []
    monkeypatch.setattr(lm, "_round", lambda windows, *_: seen.append({r.place for r in windows.collect()}))
    monkeypatch.setattr(lm, "SHARD", 300)
    lm.train(rows, lm.word_counts(rows.select("body")), PATH)
    # Each window in one round.
    assert len(seen) == lm.ROUNDS and sum(map(len, seen)) == len(set().union(*seen)) == 900
    assert min(map(len, seen)) > 200


def test_lm_shuffles_packed_windows_only(spark, monkeypatch):
    rows = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 11}" for j in range(300))) for i in range(40)], "doc_id bigint, text string")
    rows = rows.selectExpr("doc_id", "cast(text as binary) body")
    windows = lm.training_windows(lm._encoded(rows, PATH), 1.0, 4)
    given = sorted(r.ids for r in windows.collect())
    packed = lm._packed(windows, "<u2").collect()
    assert sorted(w.tobytes() for r in packed for w in lm._unpack(r.ids, r.n, "<u2")) == given
    # A window's past is the window before it; the ids alone are 2 bytes each.
    assert sum(len(r.ids) for r in packed) < len(given) * lm.STEP * 2
    again = lm._by_content(np.stack([np.frombuffer(w, "<i4") for w in reversed(given)]))
    assert (again == lm._by_content(np.stack([np.frombuffer(w, "<i4") for w in given]))).all()
    written = []
    monkeypatch.setattr(lm, "stored", lambda df, label, keep=lm.stored: written.append(label) or keep(df, label))
    lm.train(rows, lm.word_counts(rows.select("body")), PATH)
    assert written == ["lm-ids"]


def test_lm_missing_targets_have_no_gradient():
    model = tiny_model()
    windows = np.random.default_rng(5).integers(0, 300, (3, lm.WINDOW + 1))
    windows[1, 25:] = -1
    together = lm._gradients(model, windows)
    alone = [(int((w[lm.WINDOW - lm.STEP + 1 :] >= 0).sum()), lm._gradients(model, w[None])) for w in windows]
    assert [n for n, _ in alone] == [16, 8, 16]
    for name, grad in together.items():
        assert np.allclose(grad, sum(n * g[name] for n, g in alone) / 40, atol=1e-6), name


def test_lm_scores_are_causal_and_batch_free():
    model = tiny_model()
    rng = np.random.default_rng(2)
    long = rng.integers(0, 300, 150)
    alone = lm.sequence_scores(model, [long])
    assert len(alone) == 150
    together = lm.sequence_scores(model, [long[:7], long, long[:40]])
    assert np.allclose(together, np.concatenate([alone[:7], alone, alone[:40]]), atol=1e-4)
    changed = long.copy()
    changed[100:] = 7
    assert np.allclose(lm.sequence_scores(model, [changed])[:100], alone[:100], atol=1e-4)


def test_lm_gradients():
    model = tiny_model()
    for k in model.weights:
        model.weights[k] = model.weights[k].astype(np.float64)
    windows = np.random.default_rng(4).integers(0, 300, (3, lm.WINDOW + 1))

    def loss():
        w = model.weights
        slots = model.slot[windows[:, : lm.WINDOW]]
        last = slots[:, lm.WINDOW - lm.STEP :]
        query, key, value = model.tables()
        logits = np.matmul(lm._attend(query[last], key[slots], lm._offsets(model)), value[slots]) + w["next"][last]
        group = model.group[windows[:, lm.WINDOW - lm.STEP + 1 :]]
        picked = np.take_along_axis(logits, group[:, :, None], 2)[:, :, 0]
        return (np.log(np.exp(logits).sum(2)) - picked).mean()

    grads = lm._gradients(model, windows)
    slot = model.slot[windows[0, 20]]
    for name, at in (("query", (1, 2)), ("key", (3, 0)), ("value", (2, 2)), ("out", (1, 4)), ("offset", (3,)), ("embed", (slot, 3)), ("next", (slot, 2))):
        weight, kept = model.weights[name], model.weights[name][at]
        weight[at] = kept + 1e-4
        up = loss()
        weight[at] = kept - 1e-4
        down = loss()
        weight[at] = kept
        assert grads[name][at] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-7), name


def test_lm_hidden_ids_weigh_nothing():
    model = tiny_model()
    query, key, _ = model.tables()
    slots = model.slot[np.random.default_rng(6).integers(0, 300, (3, lm.WINDOW))]
    attention = lm._attend(query[slots[:, lm.WINDOW - lm.STEP :]], key[slots], lm._offsets(model))
    # Exactly 0: what was left of them made the products slow.
    assert (attention[:, lm._BACK < 0] == 0).all() and (attention[:, lm._BACK >= 0] > 0).all()


def test_lm_pass_moves_weights_as_plain_adam(monkeypatch):
    rng = np.random.default_rng(8)
    # Some ids come late, others are not seen again; 300 steps are beyond two of the moments' settlings.
    windows = np.concatenate([rng.integers(low, low + 60, (256, lm.WINDOW + 1)) for low in range(0, 300, 60)])
    one, plain = tiny_model(), tiny_model()
    steps = [np.sort(rng.integers(0, 1280, 3)) for _ in range(300)]
    monkeypatch.setattr(lm.np, "array_split", lambda *_: steps)
    lm._one_pass(one, windows, 0.01, 1)
    monkeypatch.undo()
    weights = plain.weights
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for step, rows in enumerate(steps, 1):
        for name, grad in lm._gradients(plain, windows[rows]).items():
            first[name] = 0.9 * first[name] + 0.1 * grad
            second[name] = 0.99 * second[name] + 0.01 * grad**2
            move = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
            weights[name] -= (0.01 * move).astype(np.float32)
    for name in weights:
        assert np.allclose(one.weights[name], weights[name], atol=1e-3), name
        assert np.abs(one.weights[name] - weights[name]).mean() < 1e-4, name
    # A step's gradients are rows of the slots in use only.
    _, some = lm._row_gradients(one, windows[:4], lm._Room())
    assert all(len(at) == len(grad) <= 4 * lm.WINDOW for at, grad in some.values())


def test_lm_sizes_are_packed():
    for sizes in ([0, 3, 1], [254, 255, 256, 0, 510, 70_000], [255], []):
        assert lm._unpack_sizes(lm._pack_sizes(np.array(sizes, np.int64))).tolist() == sizes


def test_lm_scores_without_training_rows(spark):
    out = lm.score_documents(frame(spark, [doc(None, "only held out"), doc(None, None)]), PATH).collect()
    assert sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out) == [
        (True, 1, 0, 0, 0.0),
        (True, 4, 0, 0, 0.0),
    ]
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_lm_encodes_each_text_once(spark, monkeypatch):
    rows = [doc(i, f"some words {i} and " + "\u6f22" * 400 * (i % 2)) for i in range(30)]
    read = {}
    monkeypatch.setattr(lm, "stored", lambda df, label, keep=lm.stored: read.update({label: df.inputFiles()}) or keep(df, label))
    assert lm.score_documents(frame(spark, rows), PATH).count() == 30
    # Training and scoring read the same stored ids.
    assert set(read) == {"lm-counts", "lm-ids", "lm-scores"}
    assert read["lm-scores"] and all("/lm-ids-" in path for path in read["lm-scores"])


# --- 6: line dedup ---


def test_line_dedup(spark):
    rows = [doc(i, f"Menu \n\nbody {i}\nMenu\nonly a", "a") for i in range(5)]
    rows += [doc(10 + i, f"body {i}\nMenu", "b") for i in range(3)]
    rows += [doc(20 + i, f"t {i}\n" + ("rare" if i < 4 else "x"), "c") for i in range(100)]
    rows += [doc(200, None, "a"), doc(201, "", "a"), doc(202, "Menu", "a"), doc(203, "Menu", None), rows[0]]
    out = lines.drop_boilerplate(frame(spark, rows), ratio=0.04, min_pages=4).collect()
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out if r.doc_id not in (200,))
    assert got[0] == got[1] == (0, "\nbody 0", 5, 3)
    texts = {r.doc_id: r.text for r in out}
    assert texts[200] is None and texts[201] == "" and texts[202] == "" and texts[203] == "Menu"
    assert texts[10] == "body 0\nMenu" and texts[20] == "t 0\nrare" and texts[24] == "t 4"
    assert "host" in out[0].__fields__ and out[0]["keys"] == "x"
    assert lines.without_boilerplate(frame(spark, rows)).columns == frame(spark).columns
    assert lines.drop_boilerplate(frame(spark, [])).count() == 0


def limited(spark, size, make):
    """What ``make`` gives while tables up to ``size`` bytes may be sent to all tasks."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        return make()
    finally:
        spark.conf.set(name, before)


def test_parts_of_dropped_lines_are_not_taken_for_small(spark):
    rows = [doc(i, "\n".join(f"menu {i % 2} {k}" for k in range(200)) + f"\nbody {i}", f"s{i % 2}") for i in range(12)]
    docs = frame(spark, rows)
    found = {}
    # Stored, the 400 lines take some 10 kB: each of their parts alone passes the first limit, unpacked and all together they do not.
    for size in ("20000", "10000000", "-1"):
        made = limited(spark, size, lambda: lines.drop_boilerplate(docs))
        joins = re.findall(r"(\w+Join)\b[^\n]*LeftSemi", made._jdf.queryExecution().executedPlan().toString())
        got = limited(spark, size, made.collect)
        found[size] = joins[0], sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got)
    assert [found[size][0] for size in ("20000", "10000000", "-1")] == ["SortMergeJoin", "BroadcastHashJoin", "SortMergeJoin"]
    assert all(f[1] == sorted((i, f"body {i}", 201, 200) for i in range(12)) for f in found.values())


# --- 7: packing ---


def test_tokens_equal_whole_text():
    texts = [r[1] or "" for r in documents()] + ["A<|endoftext|>b <|ENDOFTEXT|>", "don't I'LL", "\u00a0x\u3000y\x1cz", "\u0130\u03a3 e\u0301"]
    whole = Tokenizer.from_file(PATH)
    expect = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder = WordEncoder(PATH)
    assert encoder.encode([t.encode() for t in texts]) == expect
    assert encoder.encode([None, b""]) == [b"", b""]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(spark, capacity):
    rows = documents()
    out = packing.pack_documents(frame(spark), PATH, capacity).collect()
    whole = Tokenizer.from_file(PATH)
    expect = Counter()
    for r in rows:
        ids = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), capacity):
            piece = ids[at : at + capacity]
            expect[(r[0], at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == expect
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    used = 0
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        used += end
    large = sum(1 for r in out if 2 * r.length > capacity)
    assert len(sequences) <= max(large, math.ceil(used / capacity) * 1.05) + 2
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0


def test_patterns_cover_the_histogram():
    rng = np.random.default_rng(3)
    histogram = Counter(rng.integers(1, 101, 5000).tolist())
    patterns = packing.pack_patterns(dict(histogram), 100)
    placed = Counter()
    for packs, content in patterns:
        assert sum(content) <= 100
        for length in content:
            placed[length] += packs
    assert placed == histogram
    total = sum(k * n for k, n in histogram.items())
    assert sum(packs for packs, _ in patterns) <= math.ceil(total / 100) * 1.03


# --- 9: SimHash ---


def brute_prints(text):
    w = (text or "").translate(ASCII_LOWER).encode().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(keys, linked):
    root = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if linked(a, b) and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def test_simhash(spark):
    rows = documents()
    out = simhash.simhash_components(frame(spark)).collect()
    assert len(out) == len(rows)
    prints = {r[0]: brute_prints(r[1]) for r in rows if r[0] is not None}
    assert all((r.fp & (2**64 - 1)) == prints[r.doc_id] for r in out if r.doc_id is not None)
    root = brute_groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == root
    kept = simhash.keep_first(frame(spark))
    assert kept.columns == frame(spark).columns
    assert {r.doc_id for r in kept.collect()} == {None} | {k for k, v in root.items() if k == v}
    assert simhash.simhash_components(frame(spark, [])).count() == 0


def test_anchor_links_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = {int(x) for x in base}
    for x in base:
        for bits in range(4):
            y = int(x)
            for b in rng.choice(64, bits, replace=False):
                y ^= 1 << int(b)
            prints.add(y)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {(r.a, r.b) for r in simhash.linked_fingerprints(table, 2).collect()}
    expect = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert found == expect


def test_copies_of_prints_are_not_sent_through_the_driver(spark):
    prints = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.linked_fingerprints(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


# --- 10: repeated byte strings ---


def brute_repeats(rows, length=50):
    texts = [(k, (t or "").encode()) for k, t in rows]
    first = {}
    for key, b in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], key)
    out = Counter()
    for key, b in texts:
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - length + 1) if key is not None else []:
            if first[b[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not gone[i + 1])
        out[(key, len(b), len(b) - len(kept), spans, kept)] += 1
    return out


@pytest.mark.parametrize("ranges", [1 << 10, 8 << 20])
def test_repeats(spark, monkeypatch, ranges):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", ranges)
    out = suffixes.remove_repeats(frame(spark).repartition(5)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == brute_repeats(
        [(r[0], r[1]) for r in documents()]
    )


def test_repeats_short_length_and_empty(spark):
    rows = [doc(i, t) for i, t in enumerate(["abcdefghijkl", "xxabcdefghyy", "hijklabcdefg", "abcabcabcabc", "cabcabcabcab"])]
    out = suffixes.remove_repeats(frame(spark, rows), length=6, gram=3).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == brute_repeats(named(rows), 6)
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


def test_repeats_around_common_phrases(spark):
    rng = np.random.default_rng(6)
    phrase = "this phrase of about sixty bytes stands in very many of them"
    filler = ["".join(chr(97 + c) for c in rng.integers(0, 26, 70)) for _ in range(60)]
    rows = [doc(i, filler[i] + phrase[: 20 + i] + filler[(i * 7) % 60] + phrase) for i in range(60)]
    rows += [doc(100 + i, filler[i % 60][30:] + phrase[5:] + filler[i % 9][:40] + phrase * 2) for i in range(90)]
    out = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == brute_repeats(named(rows))
