"""SimHash near-duplicates by anchor-point covering.

Two blocks of 23 fingerprint bits are covered by the perfect binary Golay code: every block value
lies within 3 bits of exactly one code word.  Both words together are the home anchor of a
fingerprint.  A partner that differs in at most ``t`` bits differs in ``t1 + t2 <= t`` bits of
the blocks, so its home words lie within ``3 + t1`` and ``3 + t2`` bits of the other's blocks.
Every fingerprint is therefore copied to all anchors within covering radius plus threshold
(split over the blocks), about 60 copies for t = 2, and compared with the homes of each anchor.
No pair within the threshold can be missed, and a pair meets only at the home of one side.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import LOWER_BYTES, components, map_arrow, stored

BLOCK = 23
RADIUS = 3
# Generator polynomial of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
SEED = 42
_LANES = np.array(
    [[(byte >> bit) & 1 for bit in range(8)] for byte in range(256)], dtype=np.uint8
).view(np.uint64).ravel()


def bit_counts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, per group of consecutive hashes (no empty groups)."""
    starts = np.cumsum(sizes) - sizes
    # Eight 8-bit counters per word hold 255 rows: cut each group into such pieces first.
    pieces = -(-sizes // 255)
    first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(starts, pieces) + 255 * within
    lanes = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], cuts, axis=0)
    return np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64), first, axis=0, dtype=np.int64)


def fingerprints(texts: list[bytes | None], width: int = 3) -> np.ndarray:
    """64-bit SimHash of whole UTF-8 texts; 0 where a text has no words."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes: list[np.ndarray] = []
    rows: list[int] = []
    for row, text in enumerate(texts):
        words = (text or b"").translate(LOWER_BYTES).split()
        if not words:
            continue
        n = max(1, len(words) - width + 1)
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begin = np.concatenate(([0], ends[: n - 1])).tolist()
        end = (ends[-n:] - 1).tolist()
        hashes.append(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin, end)), np.uint64, n))
        rows.append(row)
    if rows:
        sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
        bits = 2 * bit_counts(np.concatenate(hashes), sizes) > sizes[:, None]
        out[rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Remainder of each block value by the generator polynomial: 0 for code words."""
    left = values.astype(np.int64)
    for i in range(BLOCK - 1, 10, -1):
        left ^= (left >> i & 1) * (GOLAY << (i - 11))
    return left


@lru_cache(maxsize=4)
def _errors(threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For t = 0, 1, ...: error patterns of weight up to RADIUS (t = 0) or exactly RADIUS + t.

    Sorted by syndrome, with the place where each syndrome begins.  A block value XOR a pattern
    of its syndrome is a code word at that distance.
    """
    out = []
    for t in range(threshold + 1):
        weights = range(RADIUS + 1) if t == 0 else [RADIUS + t]
        patterns = np.array(
            [sum(1 << i for i in places) for w in weights for places in combinations(range(BLOCK), w)], np.int64
        )
        syndromes = _syndrome(patterns)
        order = np.argsort(syndromes, kind="stable")
        out.append((patterns[order], np.searchsorted(syndromes[order], np.arange(2**11 + 1))))
    return out


def _expand(rows: np.ndarray, values: np.ndarray, threshold: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and code words that are RADIUS + t away (t = 0: RADIUS at most)."""
    patterns, begin = _errors(threshold)[t]
    syndromes = _syndrome(values)
    counts = begin[syndromes + 1] - begin[syndromes]
    at = np.repeat(begin[syndromes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return np.repeat(rows, counts), np.repeat(values, counts) ^ patterns[at]


def anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home anchor of each fingerprint; rows and anchors of all that it must visit, home included."""
    mask = np.uint64((1 << BLOCK) - 1)
    low = (prints & mask).astype(np.int64)
    high = (prints >> np.uint64(BLOCK) & mask).astype(np.int64)
    everyone = np.arange(len(prints))
    rows, visits = [], []
    for t in range(threshold + 1):
        mine, first = _expand(everyone, low, threshold, t)
        for other in range(threshold - t + 1):
            at, second = _expand(np.arange(len(mine)), high[mine], threshold, other)
            rows.append(mine[at])
            visits.append(first[at] << BLOCK | second)
    # The pair t = other = 0 comes first: exactly one word per block, the home.
    return visits[0], np.concatenate(rows), np.concatenate(visits)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as LONG) of every row; a null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = fingerprints(batch.column(1).to_pylist(), width)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows, one, f"id {kind}, fp bigint")


def linked_fingerprints(prints: DataFrame, threshold: int = 2) -> DataFrame:
    """Pairs (``a``, ``b``) of different fingerprints at most ``threshold`` bits apart.

    ``prints`` has one row per distinct ``fp``.  A fingerprint has a bounded number of possible
    partners (2,080 for two bits), so the pairs grow with the rows however large a group is.
    """

    def copies(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        home, rows, visits = anchors(fps.view(np.uint64), threshold)
        away = visits != home[rows]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([home, visits[away]])),
                pa.array(np.concatenate([fps, fps[rows[away]]])),
                pa.array(np.concatenate([np.ones(len(fps), bool), np.zeros(away.sum(), bool)])),
            ],
            names=["anchor", "fp", "home"],
        )

    spread = map_arrow(prints.select("fp"), copies, "anchor bigint, fp bigint, home boolean")
    homes = spread.where("home").select("anchor", F.col("fp").alias("a"))
    visitors = spread.select("anchor", F.col("fp").alias("b"), "home")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    # The planner knows the size of the stored prints, not of their copies: by that it would send millions of rows through the driver.
    homes, visitors = homes.hint("merge"), visitors.hint("merge")
    # Two homes of one anchor meet in both orders, a visitor meets a home at each side's anchor.
    return homes.join(visitors, "anchor").where((F.col("a") < F.col("b")) & close).select("a", "b")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: int = 2
) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``: the smallest id reachable over links.

    Rows link when their fingerprints differ in at most ``threshold`` bits.  Equal fingerprints
    are one node, so a group of copies of any size is one row of the pair search.  Texts without
    words share fingerprint 0.  Rows with a null id are linked through their texts but are never
    the smallest id; a group of null ids only has a null component.  Repeated rows are returned
    as often as they come; an empty table gives an empty result.
    """
    rows = stored(with_fingerprints(docs, id_col, text_col, width), "simhash-prints")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    groups = components(linked_fingerprints(nodes, threshold), "simhash")
    # The component of fingerprints is named by its smallest document id, not its smallest bits.
    named = nodes.join(groups.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component_id", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = stored(named.join(smallest, "root").select("fp", "component_id"), "simhash-groups")
    return rows.join(of_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: int = 2) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id (a null id stays)."""
    found = simhash_components(docs, id_col, text_col, width, threshold)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")
