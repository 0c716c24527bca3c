"""Small tables with nulls, empty and long texts, copies, ties and columns of clashing names."""

from __future__ import annotations

import random

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "words string, spans string, host string, keys string, id string, body string, row string, label string, score string"
)
EXTRA = ("x",) * 9


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "d\u00e9lta", "eps", "zeta7", "Eta,", "theta."]) + str(rng.randrange(40)) for _ in range(n))


def doc(doc_id, text, source="s0", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def documents() -> list[tuple]:
    rng = random.Random(11)
    shared = sentence(rng, 60)
    rows = [doc(i, sentence(rng, rng.randrange(1, 90)), f"s{i % 3}") for i in range(40)]
    rows += [doc(100 + i, shared, "s0") for i in range(6)]
    rows += [doc(110 + i, shared + f" tail{i}", "s1") for i in range(5)]
    rows += [doc(120 + i, sentence(rng, 20) + "\n" + shared + "\n" + sentence(rng, 20), "s2") for i in range(5)]
    rows += [doc(200, None), doc(201, ""), doc(202, " \n\t "), doc(203, "one"), doc(204, "ONE"), doc(205, "x" * 3000)]
    rows += [doc(206, "\u00fc, " * 400), doc(207, "\u00fc, " * 300), doc(208, sentence(rng, 6000)), doc(209, "a\nb\n\nc")]
    rows += [rows[3], rows[3], doc(None, shared), doc(None, None), doc(210, "no source", None)]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOC_SCHEMA)
