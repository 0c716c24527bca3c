"""Inverted index for BM25 with block maxima: exact top-k that opens only the shards that can matter.

A shard holds the postings of some thousand chunks as one row of arrays, term by term.  Beside it stands
the largest contribution of every term in every shard.  For a query their sum bounds every score in
a shard: the best-bounded shard is scored first, its k-th best score is the query's threshold, and
only shards whose bound reaches it are opened.  Postings are never joined with queries row by row;
Spark joins (shard, block of queries), and a task adds up whole arrays.

Contributions are whole multiples of 1e-8, so sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions.numeric import ratio
from quarrylens.session import work_dir

# Chunks of one shard, queries scored against a shard in one call.
SHARD = 4096
QUERIES = 256
UNIT = 100_000_000
# Scores that differ by less may be equal once rounded to four places.
SLACK = UNIT // 10_000


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def postings(chunks: DataFrame, key: Sequence[str], words: Column, only: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, length); the empty term stands for the chunk itself, so lengths need no second pass.

    With ``only`` (column ``term``) other terms are dropped before anything moves.
    """
    # One projection below the explode, and no filter that the plain explode would infer from it: the
    # words of a chunk are made once.  There is always at least the empty term.
    none = F.array().cast("array<string>")
    rows = chunks.select(
        *key, F.when(words.isNotNull(), F.size(words)).alias("length"), F.concat(F.array(F.lit("")), F.coalesce(words, none)).alias("_w")
    ).select(*key, "length", F.explode_outer("_w").alias("term"))
    if only is not None:
        kept = only.select("term").union(only.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
        rows = rows.join(kept, "term", "left_semi")
    return rows.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"), F.max("length").alias("length"))


class KeywordIndex:
    """Shards and block maxima of a set of chunks, stored in the shared folder."""

    def __init__(self, key: Sequence[str], shards: DataFrame):
        self.key, self.shards = list(key), shards

    @classmethod
    def build(
        cls, chunks: DataFrame, key: Sequence[str], words: Column, k1: float = 1.2, b: float = 0.75, only: DataFrame | None = None, shard: int = SHARD
    ) -> KeywordIndex:
        found = _stored(postings(chunks, key, words, only), "postings")
        whole = found.where("term = ''").agg(F.count(F.lit(1)).alias("n"), ratio(F.sum("length"), F.count("length")).alias("avg")).first()
        df = found.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = F.log1p((whole["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
        tf = F.col("tf").cast("double")
        weight = tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * F.col("length") / F.lit(whole["avg"])))
        part = ((F.col("_idf") * weight).cast("decimal(18,8)") * UNIT).cast("bigint").alias("part")
        rows = found.where("term <> ''").join(df.select("term", idf.alias("_idf")), "term").select(*key, "term", part)
        # Whole chunks together, by hash: ranges would need a second pass for their limits.
        dealt = rows.repartition(max(1, -(-whole["n"] // shard)), *key).sortWithinPartitions(*key)
        kinds = ", ".join(f"{c}: {chunks.schema[c].dataType.simpleString()}" for c in key)
        schema = f"shard string, keys array<struct<{kinds}>>, terms array<string>, begins array<int>, places array<int>, parts array<bigint>, tops array<bigint>"
        return cls(key, _stored(dealt.mapInArrow(_packer(list(key), shard), schema), "shards"))

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """Best ``k`` chunks of each query (query_id, term): ``query_id``, key and ``score`` in units of 1e-8."""
        asked = queries.select("query_id", "term").distinct()
        tops = self.shards.select("shard", F.explode(F.arrays_zip("terms", "tops")).alias("t")).select("shard", "t.terms", "t.tops")
        bounds = asked.join(tops, asked["term"] == tops["terms"]).groupBy("query_id", "shard").agg(F.sum("tops").alias("bound"))
        order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "shard")
        bounds = _stored(bounds.withColumn("_at", F.row_number().over(order)), "bounds")
        terms = asked.groupBy("query_id").agg(F.collect_set("term").alias("words"))
        first = _stored(self._scored(bounds.where("_at = 1").select("query_id", "shard"), terms, k), "first")
        # A query with fewer than k hits so far has no threshold.
        best = Window.partitionBy("query_id").orderBy(F.desc("score"))
        least = first.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == k).select("query_id", F.col("score").alias("least"))
        rest = bounds.where("_at > 1").join(least, "query_id", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK))
        return first.unionByName(self._scored(rest.select("query_id", "shard"), terms, k))

    def _scored(self, pairs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
        kind = terms.schema["query_id"].dataType.simpleString()
        block = F.pmod(F.xxhash64("query_id"), F.greatest(F.lit(1), F.ceil(F.col("_n") / QUERIES)).cast("bigint"))
        counts = pairs.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
        asked = pairs.join(counts, "shard").withColumn("_block", block).join(terms, "query_id")
        blocks = asked.groupBy("shard", "_block").agg(F.collect_list(F.struct("query_id", "words")).alias("queries"))
        joined = blocks.join(self.shards, "shard").select("queries", "keys", "terms", "begins", "places", "parts")
        fields = ", ".join(f"`{c}` {self.shards.schema['keys'].dataType.elementType[c].dataType.simpleString()}" for c in self.key)
        return joined.mapInArrow(_scorer(self.key, k), f"query_id {kind}, {fields}, score bigint")


def _changes(above: pa.Array, below: pa.Array) -> np.ndarray:
    """Where two columns differ, NULL being a value of its own."""
    differ = pc.fill_null(pc.not_equal(above, below), False)
    return pc.or_(differ, pc.xor(pc.is_null(above), pc.is_null(below))).to_numpy(zero_copy_only=False)


def _packer(key: list[str], shard: int):
    """Sorted postings of a task as shards of at most ``shard`` chunks each."""

    def pack(rows: pa.Table, new: np.ndarray, number: str) -> pa.RecordBatch:
        place = np.cumsum(new) - 1
        encoded = pa.concat_arrays(rows.column("term").chunks).dictionary_encode()
        names = np.array(encoded.dictionary.to_pylist(), object)
        alphabet = np.argsort(names)
        rank = np.empty(len(names), np.int64)
        rank[alphabet] = np.arange(len(names))
        term = rank[encoded.indices.to_numpy(zero_copy_only=False)]
        part = rows.column("part").to_numpy()
        order = np.argsort(term, kind="stable")
        begins = np.searchsorted(term[order], np.arange(len(names)))
        heads = pa.array(np.flatnonzero(new))
        structs = pa.StructArray.from_arrays([pa.concat_arrays(rows.column(c).chunks).take(heads) for c in key], names=key)
        one = lambda values, kind: pa.array([values.tolist()], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs),
                one(names[alphabet], pa.string()),
                one(np.append(begins, len(order)), pa.int32()),
                one(place[order], pa.int32()),
                one(part[order], pa.int64()),
                one(np.maximum.reduceat(part[order], begins), pa.int64()),
            ],
            names=["shard", "keys", "terms", "begins", "places", "parts", "tops"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, chunks = TaskContext.get().partitionId(), 0, 0
        rows: list[pa.RecordBatch] = []
        flags: list[np.ndarray] = []
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for c in key:
                column = batch.column(c)
                new[1:] |= _changes(column.slice(0, len(column) - 1), column.slice(1))
                new[0] |= last is None or bool(_changes(last.column(c).slice(last.num_rows - 1), column.slice(0, 1))[0])
            last = batch
            while chunks + new.sum() > shard:
                # The chunk that begins here would be one too many.
                at = int(np.flatnonzero(new)[shard - chunks])
                rows.append(batch.slice(0, at))
                flags.append(new[:at])
                yield pack(pa.Table.from_batches(rows), np.concatenate(flags), f"{task}-{number}")
                number, chunks, rows, flags = number + 1, 0, [], []
                batch, new = batch.slice(at), new[at:]
            rows.append(batch)
            flags.append(new)
            chunks += int(new.sum())
        if rows:
            yield pack(pa.Table.from_batches(rows), np.concatenate(flags), f"{task}-{number}")

    return run


def _scorer(key: list[str], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                column = lambda name: batch.column(name)[i].values  # noqa: B023, E731
                keys, queries = column("keys"), column("queries").to_pylist()
                number = {t: n for n, t in enumerate(column("terms").to_pylist())}
                begins, places, parts = (column(c).to_numpy(zero_copy_only=False) for c in ("begins", "places", "parts"))
                # Keys come in order, so a place is also the key's rank.
                size = len(keys)
                ids, at, score = [], [], []
                for query in queries:
                    total = np.zeros(size, np.int64)
                    for t in query["words"]:
                        n = number.get(t)
                        if n is not None:
                            total[places[begins[n] : begins[n + 1]]] += parts[begins[n] : begins[n + 1]]
                    hits = np.flatnonzero(total)
                    rounded = np.floor(total[hits] / UNIT * 1e4 + 0.5)
                    if len(hits) > k:
                        least = np.partition(rounded, -k)[-k]
                        hits, rounded = hits[rounded >= least], rounded[rounded >= least]
                    best = hits[np.lexsort((hits, -rounded))[:k]]
                    ids += [query["query_id"]] * len(best)
                    at.append(best)
                    score.append(total[best])
                chosen = keys.take(pa.array(np.concatenate(at) if at else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("queries").type.value_type.field("query_id").type), *[chosen.field(c) for c in key], pa.array(np.concatenate(score) if score else np.zeros(0, np.int64))],
                    names=["query_id", *key, "score"],
                )

    return run
