"""Personal data: strict spans against plain patterns, added spans on planted rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from llm.data import doc, documents, frame
from quarrylens.llm import boosting, pii
from quarrylens.llm.queries import op12_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return out


def test_luhn():
    for number, good in (("4111111111111111", True), ("4111111111111112", False), ("378282246310005", True)):
        assert pii.luhn(number) is good


def test_strict_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    bits = ["a", "@", ".", "1", "23", "456", "+", "-", " ", "(", ")", "b@c.d", "1.2.3.4", "4465758382889437", "é", "0300", "+1 (523) 555-1055"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 200_000, "@" * 100_000, "1 " * 200_000, "a@" * 100_000, ":a" * 100_000):
        pii.base_spans(text)
        assert sum(1 for _ in pii.candidates(text)) <= 2 * len(text)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return pii.fit_model(pii.sample_windows(docs))


def test_held_out_figures(model):
    assert model.held_out_auc > 0.98 and model.held_out_precision > 0.95 and model.held_out_recall > 0.7


def test_added_spans(model):
    rng = random.Random(77)
    words = "the order of that has been for a while and it is on".split()
    around = lambda: " ".join(rng.choice(words) for _ in range(12))
    caught = clean = 0
    for i in range(400):
        cue, span = pii.positive(rng, pii.KINDS[i % 4])
        head = around() + " " + cue
        text = head + span + ", " + around()
        found = pii.base_spans(text) + [c[:3] for c in pii.added_spans([text], [pii.base_spans(text)], model)[0]]
        caught += any(b < len(head) + len(span) and e > len(head) for _, b, e in found)
        text = around() + " " + pii.negative(rng) + " " + around()
        clean += not pii.added_spans([text], [pii.base_spans(text)], model)[0]
    assert caught >= 0.75 * 400 and clean >= 0.95 * 400


def test_two_numbers_in_one_run(model):
    text = "pay with card 4465758382889437 4465758382889437 today"
    assert pii.base_spans(text) == []
    added = pii.added_spans([text], [[]], model)[0]
    assert {(k, b, e) for k, b, e, _ in added} == {("card", 14, 30), ("card", 31, 47)}


def test_edge_rows_and_strict_counts(spark, model):
    rows = documents() + [
        doc(500, "a@b.co 10.0.0.256 10.0.0.25 4111 1111 1111 1111 +1 (523) 555-1055"),
        doc(501, "é a@b.co.uk a@b é@c.de"),
        doc(500, "again a@b.co"),
        doc(None, "x@y.zz"),
        doc(None, None),
    ]
    got = sorted(map(tuple, pii.digest(pii.find_spans(frame(spark, rows), model)).collect()), key=repr)
    assert len(got) == len(rows)
    want = []
    for r in rows:
        spans = plain(r[1] or "")
        listed = ",".join(f"{k}:{b}:{e}" for k, b, e in spans)
        counts = [sum(k == kind for k, _, _ in spans) for kind in pii.KINDS]
        want.append((r[0], *counts, hashlib.sha256(listed.encode()).hexdigest()))
    assert [g[:6] for g in got] == sorted(want, key=repr)
    for g in got:
        places = [s.split(":") for s in g[6].split(",")] if g[6] else []
        assert len(places) >= sum(g[1:5]) and places == sorted(places, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


def test_redacted_keeps_the_rest(spark, model):
    rows = [doc(1, "mail a@b.co now"), doc(2, None), doc(3, "nothing here"), doc(4, "")]
    got = {r["doc_id"]: r for r in pii.redacted(frame(spark, rows), model).collect()}
    assert [got[i]["text"] for i in (1, 2, 3, 4)] == ["mail [EMAIL] now", None, "nothing here", ""]
    assert got[1]["score"] == "x" and pii.redact("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"


def test_no_rows(spark):
    assert pii.personal_data(frame(spark, [])).count() == 0
    got = pii.personal_data(frame(spark, [doc(1, None), doc(2, "")])).collect()
    assert [tuple(r)[:5] for r in got] == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)] and {r["spans"] for r in got} == {""}


def test_query_over_the_given_table(spark):
    got = {r["doc_id"]: r for r in op12_pii(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        listed = ",".join(f"{k}:{b}:{e}" for k, b, e in plain(r["text"] or ""))
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(got[r["doc_id"]]["spans"].split(","))


def test_boosted_trees():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(rows[:2000], labels[:2000], depth=2)
    boosting.calibrate(trees, rows[2000:2500], labels[2000:2500])
    p = trees.probability(rows[2500:])
    assert boosting.auc(p, labels[2500:]) > 0.97
    assert abs(p.mean() - labels[2500:].mean()) < 0.05
    limit = boosting.threshold(p, labels[2500:], 0.95)
    assert labels[2500:][p >= limit].mean() >= 0.95
    assert boosting.threshold(np.array([0.9, 0.8]), np.zeros(2), 0.9) > 1
