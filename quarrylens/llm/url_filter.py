"""URL filter: host and path rules, and a logistic regression on character n-grams for the rest."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import lower_ascii, map_arrow

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
# Bound of the labelled URL table that the model is fitted on.
TABLE_ROWS = 4096


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the beginning of a path, like ``example.com/en/``."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Text after the first ``://`` up to ``/ ? #`` in lower case, then up to ``? #``; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (ties: the smaller text), else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    if not ordered:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    text = F.coalesce(*[F.when(r.fits(host, path), F.lit(r.text)) for r in ordered])
    verdict = F.coalesce(*[F.when(r.fits(host, path), F.lit(r.verdict)) for r in ordered])
    return text, verdict


def ngrams(host: str, path: str) -> np.ndarray:
    """Hash buckets of all character n-grams; host and path have buckets of their own."""
    found = []
    for seed, text in ((1, f"^{host}$"), (2, f"^{path}$")):
        raw = text.encode()
        found += [zlib.crc32(raw[i : i + n], seed) for n in SIZES for i in range(len(raw) - n + 1)]
    return np.unique(np.array(found, np.int64) % BUCKETS)


@dataclass
class Model:
    bias: float
    weights: np.ndarray

    def blocked(self, host: str, path: str) -> float:
        """Probability of ``block``."""
        at = ngrams(host, path)
        margin = self.bias + self.weights[at].sum() / np.sqrt(max(1, len(at)))
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(labelled: DataFrame, rows: int = TABLE_ROWS, passes: int = 10) -> Model:
    """Fit on a table of ``host, path, verdict``: at most ``rows`` distinct URLs, by hash order.

    Batches of 32, Adam, fixed seed.  Null verdicts do not count; without rows all is allowed.
    """
    known = labelled.where(F.col("verdict").isNotNull()).select("host", "path", "verdict").distinct()
    sample = known.orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(rows).collect()
    y = np.array([r["verdict"] == "block" for r in sample], np.float64)
    at = [ngrams(r["host"], r["path"]) for r in sample]
    model, rng = Model(0.0, np.zeros(BUCKETS)), np.random.default_rng(5)
    first, second = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    step = 0
    for _ in range(passes):
        for rows_ in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            grad = np.zeros(BUCKETS + 1)
            for r in rows_:
                scale = 1 / np.sqrt(max(1, len(at[r])))
                margin = model.bias + model.weights[at[r]].sum() * scale
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[r]) / len(rows_)
                grad[at[r]] += error * scale
                grad[BUCKETS] += error
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad**2
            move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            model.weights -= move[:BUCKETS]
            model.bias -= float(move[BUCKETS])
    return model


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    table_rows: int = TABLE_ROWS,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, block_score`` for every row.

    A rule that fits decides; else the model does: block above 0.5.  ``labelled`` is a table of
    ``host, path, verdict``; by default the URLs that a rule decides teach the model.  A null URL
    or one without ``://`` has an empty host and path and is judged like any other; null ids and
    repeated rows come back as they are; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", text.alias("rule"), verdict.alias("verdict"))
    model = fit(rows if labelled is None else labelled, table_rows)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        scores = pa.array([model.blocked(h, p) for h, p in pairs], pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "block_score"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, host string, path string, rule string, verdict string, block_score double"
    own = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return map_arrow(rows, one, schema).select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "block_score"
    )
