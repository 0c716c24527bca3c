"""Phrase collocations and their automata against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.data import doc, documents, frame
from quarrylens.llm import collocations
from quarrylens.llm.transducer import Transducer, union

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, best=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    f[lang][tuple(w[i : i + size])] += 1
    out = []
    for lang, c in f.items():
        candidates = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        gone = set()
        for g, a in candidates.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    if 100 * a >= 80 * c[g[i : i + size]]:
                        gone.add(g[i : i + size])
        rows = []
        for g, a in candidates.items():
            if g not in gone:
                score, k = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("min_count", [2, 6])
def test_collocations(spark, min_count):
    rng = random.Random(4)
    texts = ["New York City is big. new york Times!", "in spite of\tthe rain in  spite of it", "a a a a a a a a", "wörter\x00odd space line, wörter\x00odd"]
    rows = documents() + [doc(900 + i, rng.choice(texts) + " " + rng.choice(texts), lang=rng.choice(["en", "de", None, "und", ""])) for i in range(60)]
    got = found(collocations.collocations(frame(spark, rows), min_count=min_count))
    want = brute([(r[2], r[1]) for r in rows], min_count)
    assert len({r[0] for r in want}) > 2
    assert got == want


def test_best_and_ranges(spark, monkeypatch):
    """More prefix ranges, early unions and a full bit table change nothing."""
    rows = documents()
    want = brute([(r[2], r[1]) for r in rows], 3, 7)
    monkeypatch.setattr(collocations, "RANGE_WORDS", 50)
    monkeypatch.setattr(collocations, "_frequent_bits", lambda counts, level: np.full(collocations.BITS // 8, 255, np.uint8))
    assert found(collocations.collocations(frame(spark, rows), min_count=3, best=7)) == want


def test_no_phrases(spark):
    assert found(collocations.collocations(frame(spark, []))) == []
    assert found(collocations.collocations(frame(spark, [doc(1, None), doc(2, ""), doc(None, "one two")]))) == []


def automaton(counts):
    labels = sorted({w for g in counts for w in g})
    place = {w: i for i, w in enumerate(labels)}
    rows = sorted(counts)
    grams = np.array([[place[w] for w in g] + [-1] * (4 - len(g)) for g in rows], np.int32).reshape(-1, 4)
    return Transducer.build(labels, grams, np.array([counts[g] for g in rows], np.int64))


def contents(t):
    grams, weights = t.grams(4)
    return {tuple(t.labels[i] for i in g if i >= 0): int(w) for g, w in zip(grams, weights)}


def test_automata():
    rng = random.Random(2)
    draw = lambda: Counter(tuple(rng.choice([b"a", b"b", b"cc", b"d"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(60)))
    for _ in range(60):
        a, b = draw(), draw()
        one, two = automaton(a), automaton(b)
        assert contents(one) == a and contents(Transducer.from_bytes(one.to_bytes())) == a
        assert contents(union([one, two], 4, 3)) == {g: n for g, n in (a + b).items() if n >= 3}
        asked = sorted(a)
        which, counts = automaton({g: i for i, g in enumerate(asked)}).compose(two, 4)
        assert {asked[i]: n for i, n in zip(which, counts)} == {g: b[g] for g in a if g in b}


def test_equal_ends_share_states():
    t = automaton({(first, b"of", last): 5 for first in (b"a", b"b", b"c") for last in (b"x", b"y")})
    assert len(t.final) == 4
