"""Exact cosine top-k for many queries: clusters with radii, skipped by the triangle inequality.

Vectors are packed into blocks of one cluster, with the least and greatest angle to the cluster's centre.  A
query first meets its own cluster; its k-th best score there is a threshold.  By the triangle inequality on
angles, no vector of another cluster comes closer than the gap between the query's angle to that
centre and the cluster's own range of angles, so only clusters that can reach the threshold are
opened.  Queries are rows throughout: Spark joins (block of vectors, block of queries) on the
cluster, a task multiplies two matrices and returns the best k of each query.

Only the centres (fitted on at most ``SAMPLE`` vectors) and one range of angles per cluster pass the driver;
every vector is indexed, and the centres decide how much is skipped, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.operators.keyword_index import _stored

SAMPLE = 4096
CLUSTERS = 64
# Vectors of a block.
ROWS = 8192
# Scores are rounded to six places; closer ones may be equal.
SLACK = 2e-6


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without NULLs, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(rows, axis=1)
    good = np.isfinite(norms) & (norms > 0)
    return rows / np.where(good, norms, 1.0)[:, None], good


def centres_by_sample(emb: DataFrame, id_col: str, sample: int = SAMPLE, clusters: int = CLUSTERS, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on the ``sample`` vectors whose ids hash lowest."""
    rows = emb.orderBy(F.xxhash64(id_col), id_col).limit(sample).select("embedding").collect()
    if not rows:
        return np.zeros((0, 0))
    units, good = _units(np.array([r["embedding"] for r in rows], np.float64))
    units = units[good]
    centres = units[: max(1, min(clusters, int(len(units) ** 0.5)))] if len(units) else np.zeros((1, units.shape[1]))
    for _ in range(rounds if len(units) else 0):
        nearest = (units @ centres.T).argmax(1)
        sums = np.stack([np.bincount(nearest, units[:, d], len(centres)) for d in range(units.shape[1])], 1)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centres)
    return centres


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


class VectorIndex:
    """Blocks of vectors by cluster; ``emb`` holds ``id_col`` and ``embedding``. NULL, zero and non-finite vectors have no cosine."""

    def __init__(self, blocks: DataFrame, centres: np.ndarray, id_col: str, id_type: str):
        self.blocks, self.centres, self.id_col, self.id_type = blocks, centres, id_col, id_type

    @classmethod
    def build(cls, emb: DataFrame, id_col: str = "vec_id", rows: int = ROWS, sample: int = SAMPLE) -> VectorIndex:
        emb = emb.where(F.col("embedding").isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col("embedding").cast("array<double>").alias("embedding"))
        id_type = emb.schema[id_col].dataType.simpleString()
        centres = centres_by_sample(emb, id_col, sample)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                units, good = _units(_matrix(batch.column(1)))
                angles = _angles(units[good], centres)
                nearest = angles.argmin(1)
                kept = pa.array(np.flatnonzero(good))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest.astype(np.int32)), pa.array(angles[np.arange(len(nearest)), nearest]), *[c.take(kept) for c in batch.columns]],
                    names=["cluster", "angle", "id", "embedding"],
                )

        placed = _stored(emb.mapInArrow(assign, f"cluster int, angle double, id {id_type}, embedding array<double>"), "vectors")
        counts = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
        part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / rows).cast("bigint")).alias("part")
        dealt = placed.join(counts, "cluster").select("cluster", part, "angle", "id", "embedding")
        packed = dealt.groupBy("cluster", "part").applyInArrow(
            _pack, f"cluster int, low double, high double, ids array<{id_type}>, vectors array<double>"
        )
        return cls(_stored(packed, "vector-blocks"), centres, id_col, id_type)

    def search(self, queries: DataFrame, k: int, block: int = 512) -> DataFrame:
        """``query_id``, id and ``score`` (rounded to six places): the best k of each query and some more."""
        kind = queries.schema["query_id"].dataType.simpleString()
        queries = queries.where(F.col("centre").isNotNull()).select("query_id", F.col("centre").cast("array<double>").alias("centre"))
        home = _stored(self._visits(queries, kind, None), "visits")
        first = _stored(self._scored(home, k, block, kind), "near")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"))
        least = first.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == k).select("query_id", F.col("score").alias("least"))
        rest = home.select("query_id", "centre").join(least, "query_id", "left")
        spans = self.blocks.groupBy("cluster").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
        return first.unionByName(self._scored(self._visits(rest, kind, {r["cluster"]: (r["low"], r["high"]) for r in spans}), k, block, kind))

    def _visits(self, queries: DataFrame, kind: str, spans: dict[int, tuple[float, float]] | None) -> DataFrame:
        """(query, cluster): the nearest cluster, or all others that can reach ``least`` (all, where that is NULL)."""
        centres = self.centres
        low, high = np.full(len(centres), np.inf), np.full(len(centres), np.inf)
        for cluster, (a, b) in (spans or {}).items():
            low[cluster], high[cluster] = a, b

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not len(centres):
                    continue
                units, good = _units(_matrix(batch.column(1)))
                angles = _angles(units, centres)
                nearest = angles.argmin(1)
                if spans is None:
                    row, cluster = np.flatnonzero(good), nearest[good]
                else:
                    least = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                    gap = np.maximum(0.0, np.maximum(low - angles, angles - high))
                    reach = np.where(gap <= np.pi, np.cos(np.minimum(gap, np.pi)), -np.inf)
                    open_ = (reach >= np.where(np.isnan(least), -2.0, least - SLACK)[:, None]) & good[:, None] & np.isfinite(low)
                    open_[np.arange(len(nearest)), nearest] = False
                    row, cluster = np.nonzero(open_)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(cluster.astype(np.int32))], names=["query_id", "centre", "cluster"]
                )

        return queries.mapInArrow(visit, f"query_id {kind}, centre array<double>, cluster int")

    def _scored(self, visits: DataFrame, k: int, block: int, kind: str) -> DataFrame:
        counts = visits.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
        slot = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("_n") / block).cast("bigint")).alias("_slot")
        asked = visits.join(counts, "cluster").groupBy("cluster", slot).agg(F.collect_list(F.struct("query_id", "centre")).alias("queries"))
        joined = asked.join(self.blocks, "cluster").select("queries", "ids", "vectors")
        return joined.mapInArrow(_scorer(k, self.id_col), f"query_id {kind}, {self.id_col} {self.id_type}, score double")


def _pack(group: pa.Table) -> pa.Table:
    """One block of one cluster; its ids in order, so places are ranks."""
    group = group.sort_by("id").combine_chunks()
    angle = group.column("angle").to_numpy()
    ids, vectors = (pa.concat_arrays(group.column(c).chunks) for c in ("id", "embedding"))
    flat = vectors.flatten()
    return pa.table(
        {
            "cluster": group.column("cluster").slice(0, 1),
            "low": [angle.min()],
            "high": [angle.max()],
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "vectors": pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat),
        }
    )


def _scorer(k: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked, ids, flat = (batch.column(c)[i].values for c in ("queries", "ids", "vectors"))
                data = flat.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                rows = _matrix(asked.field("centre"))
                sims = (rows @ data.T) / (np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(data, axis=1)[None, :])
                sims = np.floor(np.abs(sims) * 1e6 + 0.5) / 1e6 * np.sign(sims) + 0.0
                of, at = [], []
                for row, score in enumerate(sims):
                    hits = np.flatnonzero(score >= np.partition(score, -k)[-k]) if len(score) > k else np.arange(len(score))
                    best = hits[np.lexsort((hits, -score[hits]))[:k]]
                    of.append(np.full(len(best), row))
                    at.append(best)
                of, at = np.concatenate(of), np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [asked.field("query_id").take(pa.array(of)), ids.take(pa.array(at)), pa.array(sims[of, at])], names=["query_id", id_col, "score"]
                )

    return run
