"""Packing documents into fixed-length sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.llm.common import map_arrow, stored
from quarrylens.llm.tokens import word_encoder

END = 2
# Rows of one length that one window partition ranks, on average.
RANK_ROWS = 200_000


def pack_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(number of packs, lengths in one pack) for all items of the histogram.

    Lengths are placed longest first.  Each goes into the packs with the fewest tokens so far; if
    these have no room, new packs are opened.  Packs with equal contents are one entry with a
    count, so the work depends on the number of lengths, not on the number of documents.
    """
    # (tokens, order, packs, node); node = (parent, length) is the pattern built so far.
    open_packs: list[tuple[int, int, int, tuple]] = []
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= capacity:
                used, _, packs, node = heapq.heappop(open_packs)
                taken = min(left, packs)
                if packs > taken:
                    order += 1
                    heapq.heappush(open_packs, (used, order, packs - taken, node))
            else:
                used, taken, node = 0, left, ()
            order += 1
            heapq.heappush(open_packs, (used + length, order, taken, (node, length)))
            left -= taken
    out = []
    for _, _, packs, node in sorted(open_packs):
        lengths: list[int] = []
        while node:
            node, length = node
            lengths.append(length)
        out.append((packs, lengths[::-1]))
    return out


def _slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """One entry per slot of a pattern: the ranks of its length that it takes, and where they go."""
    lengths, ranks, sequences, offsets = [], [], [], []
    taken: dict[int, int] = {}
    sequence = 0
    for packs, content in patterns:
        offset = 0
        for length in content:
            lengths.append(length)
            ranks.append(taken.get(length, 0))
            sequences.append(sequence)
            offsets.append(offset)
            taken[length] = taken.get(length, 0) + packs
            offset += length
        sequence += packs
    slots = {"length": lengths, "rank": ranks, "sequence": sequences, "offset": offsets}
    out = {k: np.array(v, np.int64) for k, v in slots.items()}
    at = np.lexsort((out["rank"], out["length"]))
    return {k: v[at] for k, v in out.items()}


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Every document's ids and the end id, cut at multiples of ``capacity``."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, start, length, crc, total = [], [], [], [], []
        for row, ids in enumerate(word_encoder(tokenizer).encode(batch.column(1).to_pylist())):
            ids += end
            for at in range(0, len(ids), 4 * capacity):
                piece = ids[at : at + 4 * capacity]
                owner.append(row)
                start.append(at // 4)
                length.append(len(piece) // 4)
                crc.append(zlib.crc32(piece))
                total.append(len(ids) // 4)
        arrays = [batch.column(0).take(pa.array(owner)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return map_arrow(rows, one, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and one end id (a null or empty text: the end id alone).  It is cut at
    multiples of ``capacity``; each piece lies whole in one sequence.  The driver sees only the
    histogram, at most ``capacity`` numbers; patterns go back to pieces by their rank among the
    pieces of one length.  Ranks are counted per hash bucket and shifted by the buckets before,
    so a length that a third of all rows share is ranked by many tasks.  Repeated rows and null
    ids are documents like any other.  An empty table gives an empty result.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, id_col, text_col), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(pack_patterns(histogram, capacity))

    buckets = 16 + sum(histogram.values()) // RANK_ROWS
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sizes = spread.groupBy("length", "bucket").count()
    before = F.sum("count").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = spread.withColumn("nth", F.row_number().over(within)).join(shifts, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("shift") + F.col("nth") - 1).alias("rank")
    )
    first = np.searchsorted(slots["length"], np.arange(capacity + 2))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length = batch.column(2).to_numpy()
        rank = batch.column(5).to_numpy()
        slot = np.empty(len(length), np.int64)
        for size in np.unique(length):
            mine = length == size
            a, b = first[size], first[size + 1]
            slot[mine] = a + np.searchsorted(slots["rank"][a:b], rank[mine], side="right") - 1
        sequence = slots["sequence"][slot] + rank - slots["rank"][slot]
        columns = [batch.column(i) for i in range(5)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(sequence), pa.array(slots["offset"][slot])],
            names=[*batch.schema.names[:5], "sequence_id", "offset"],
        )

    kind = ranked.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        ranked,
        place,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
