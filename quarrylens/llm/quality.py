"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import LOWER_BYTES, held_out, map_arrow

FOLDS = 5
THRESHOLD = 0.3
WORD_BUCKETS = 1 << 12
FACTORS = 8
# Bound of the training sample: rows with the smallest hash of their id.
SAMPLE_ROWS = 6000
STATS = 15

_CLASS = np.zeros((256, 6), np.float32)
_CLASS[ord("A") : ord("Z") + 1, 0] = 1
_CLASS[ord("0") : ord("9") + 1, 1] = 1
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()], 2] = 1
_CLASS[[32, 9, 10, 11, 12, 13], 3] = 1
_CLASS[[ord("!"), ord("?")], 4] = 1
_CLASS[128:, 5] = 1


@dataclass
class Model:
    """Centre and scale of the statistics; bias, linear weights and factors of all inputs."""

    centre: np.ndarray
    scale: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def inputs(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.centre) / self.scale, -4, 4) / 4
        return np.concatenate([words, scaled], axis=1, dtype=np.float32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Bias + linear part + all pairwise products, in time linear in the inputs:
        sum over pairs of <v_i, v_j> x_i x_j is half of (sum v x)^2 - sum (v x)^2."""
        total = x @ self.factors
        squares = (x * x) @ (self.factors**2)
        return self.bias + x @ self.weights + 0.5 * (total**2 - squares).sum(axis=1)

    def score(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.inputs(words, stats)), -30, 30).astype(np.float64)))


def features(text: bytes | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word frequencies (unit length) and structure statistics of one whole text."""
    text = text or b""
    words = text.translate(LOWER_BYTES).split()
    n = len(words)
    hashed = np.fromiter(map(zlib.crc32, words), np.uint32, n) & (WORD_BUCKETS - 1)
    counts = np.bincount(hashed, minlength=WORD_BUCKETS).astype(np.float32)
    classes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / max(1, len(text))
    lines = text.split(b"\n")
    stats = np.array(
        [
            np.log1p(len(text)),
            np.log1p(n),
            len(text) / (n + 1),
            *classes,
            len(set(words)) / max(1, n),
            counts.max() / max(1, n),
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            np.log1p(len(lines)),
            np.log1p(max(0.0, len(text) if n_chars is None else n_chars)),
        ],
        np.float32,
    )
    return counts / max(1.0, float(np.linalg.norm(counts))), stats


def _stack(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    texts, chars = batch.column(first).to_pylist(), batch.column(first + 1).to_pylist()
    words = np.zeros((len(texts), WORD_BUCKETS), np.float32)
    stats = np.zeros((len(texts), STATS), np.float32)
    for row, pair in enumerate(zip(texts, chars)):
        words[row], stats[row] = features(*pair)
    return words, stats


def _rows(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    chars = F.col(chars_col).cast("double") if chars_col in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), chars.alias("chars"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    label_col: str = "quality",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    sample_rows: int = SAMPLE_ROWS,
    passes: int = 12,
) -> Model:
    """Learn from at most ``sample_rows`` labelled ids for which ``train`` (over ``id``) holds.

    An id labelled more than once counts with its mean label; null labels do not count.  Features
    are made by the tasks; the driver holds at most ``sample_rows`` times ``WORD_BUCKETS`` pairs.
    Without any label the model scores 0.5.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    known = known.where(F.col("id").isNotNull() & F.col("y").isNotNull())
    if train is not None:
        known = known.where(train)
    known = known.groupBy("id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = _rows(docs, id_col, text_col, chars_col).join(F.broadcast(known), "id")
    rows = rows.select("text", "chars", "y", "id")

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, stats = _stack(batch, 0)
        at = [np.flatnonzero(row) for row in words]
        columns = [
            pa.array(at, pa.list_(pa.int16())),
            pa.array([row[i] for row, i in zip(words, at)], pa.list_(pa.float32())),
            pa.array(list(stats), pa.list_(pa.float32())),
            batch.column(2),
            pa.array(batch.column(3).cast(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["at", "value", "stats", "y", "id"])

    schema = "at array<smallint>, value array<float>, stats array<float>, y double, id string"
    found = map_arrow(rows, sparse, schema).toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    return train_model(
        [x.values.to_numpy() for x in found["at"]],
        [x.values.to_numpy() for x in found["value"]],
        np.array(found["stats"].to_pylist(), np.float32).reshape(-1, STATS),
        np.array(found["y"].to_pylist(), np.float32),
        passes,
    )


def train_model(at: list, value: list, stats: np.ndarray, y: np.ndarray, passes: int = 12, seed: int = 7) -> Model:
    """Logistic loss, Adam on batches of 128 rows, fixed seed: the same rows give the same model."""
    rng = np.random.default_rng(seed)
    size = WORD_BUCKETS + STATS
    centre = stats.mean(axis=0) if len(y) else np.zeros(STATS, np.float32)
    scale = (stats.std(axis=0) if len(y) else np.ones(STATS, np.float32)) + 1e-3
    model = Model(centre, scale, 0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32))
    if not len(y):
        model.factors[:] = 0
        return model
    moments: dict[str, list] = {k: [0.0, 0.0] for k in ("bias", "weights", "factors")}
    step = 0
    for _ in range(passes):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            words = np.zeros((len(rows), WORD_BUCKETS), np.float32)
            for k, row in enumerate(rows):
                words[k, at[row]] = value[row]
            x = model.inputs(words, stats[rows])
            error = (1 / (1 + np.exp(-model.margin(x))) - y[rows]).astype(np.float32) / len(rows)
            total = x @ model.factors
            grads = {
                "bias": float(error.sum()),
                "weights": x.T @ error + 1e-5 * model.weights,
                "factors": x.T @ (error[:, None] * total)
                - model.factors * ((x * x).T @ error)[:, None]
                + 1e-5 * model.factors,
            }
            step += 1
            for name, grad in grads.items():
                m = moments[name]
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.999 * m[1] + 0.001 * grad**2
                move = 0.02 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                setattr(model, name, getattr(model, name) - move)
    return model


def score(
    docs: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """``id_col``, ``held_out``, ``score``, ``predicted`` for every row, whatever its text.

    Null texts score like empty ones; a null id is its own row; repeated rows come back repeated.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(*_stack(batch, 1))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    rows = map_arrow(_rows(docs, id_col, text_col, chars_col), one, f"id {kind}, score double", 2 << 20)
    return rows.select(
        F.col("id").alias(id_col),
        held_out(F.col("id"), FOLDS).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the rows outside the held-out fold, then score every row."""
    return score(docs, fit(docs, labels, train=~held_out(F.col("id"), FOLDS), **options))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject, with their columns.

    Scores are those of ``score``: without a column ``n_chars`` that input counts as null.
    """
    model = fit(docs, labels, train=~held_out(F.col("id"), FOLDS))
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def good(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(text_at).to_pylist()
                chars = [None] * len(texts) if chars_at is None else part.column(chars_at).cast(pa.float64()).to_pylist()
                words = np.zeros((len(texts), WORD_BUCKETS), np.float32)
                stats = np.zeros((len(texts), STATS), np.float32)
                for row, (text, n) in enumerate(zip(texts, chars)):
                    words[row], stats[row] = features(None if text is None else text.encode(), n)
                yield part.filter(pa.array(model.score(words, stats) >= THRESHOLD))

    return docs.mapInArrow(good, docs.schema)
