"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from llm.data import doc, documents, frame
from quarrylens.llm import variants
from quarrylens.llm.queries import op11_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, ratio=10):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), counts.get(form.get(w)))
    return out


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def planted(rng):
    stems = ["harvester", "conveyor", "excavation", "übergröße", "naïvetés×", "aaaaaaaa", "abababab"]
    rows = []
    for stem in stems:
        bag = [stem] * 60
        for _ in range(60):
            at, letter = rng.randrange(len(stem)), rng.choice("abeoréÿ")
            bag += [rng.choice([stem[:at] + stem[at + 1 :], stem[:at] + letter + stem[at:], stem[:at] + letter + stem[at + 1 :]])] * rng.randrange(1, 5)
        rng.shuffle(bag)
        rows += [" ".join(bag[i::9]) for i in range(9)]
    return rows


def test_variants(spark):
    texts = planted(random.Random(3)) + ["Abcdefg1abcdefh.abcdefG abcdefh中abcdefg " * 3, "q" * 5000 + " " + "q" * 4999 + " " + "q" * 5000 + " " + "q" * 4999]
    rows = documents() + [doc(1000 + i, t) for i, t in enumerate(texts)]
    want = brute([(r[0], r[1]) for r in rows])
    assert sum(v[0] is not None for v in want.values()) > 50
    assert found(variants.variants(frame(spark, rows))) == want


@pytest.mark.parametrize("tile", [1, 6])
def test_large_blocks_are_cut_finer(spark, tile):
    rows = [doc(i, t) for i, t in enumerate(planted(random.Random(5)))]
    assert found(variants.variants(frame(spark, rows), tile=tile)) == brute([(r[0], r[1]) for r in rows])


def test_chain_of_forms_and_ties(spark):
    rows = [doc(7, "lantern " * 1), doc(8, "lanterns " * 400 + "lanternss " * 40 + "alanternss " * 4 + "zlanternss " * 4)]
    want = brute([(r[0], r[1]) for r in rows])
    got = found(variants.variants(frame(spark, rows)))
    assert got == want and got["alanternss"][:2] == ("lanternss", "lanterns")
    assert found(variants.variants(frame(spark, [doc(1, "wordones wordonet wordones wordonet wordonex " * 10)]))) == brute(
        [(1, "wordones wordonet wordones wordonet wordonex " * 10)]
    )


def test_no_words(spark):
    assert variants.variants(frame(spark, [])).count() == 0
    assert variants.variants(frame(spark, [doc(1, None), doc(2, ""), doc(None, "short once")])).count() == 0


def test_query_over_the_given_table(spark):
    got = op11_variants(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert found(got) == brute([tuple(r) for r in rows])
