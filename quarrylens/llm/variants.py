"""Spelling variants: words that differ by one inserted, deleted or replaced letter.

Dense prefix-suffix tiling.  Two words whose longer one has ``m`` letters differ by one edit
exactly when common prefix plus common suffix reach ``m - 1``.  The edit then lies in one of
``SEGMENTS`` stretches of the longer word, and everything outside that stretch is equal: a block is
(m, stretch, letters before it, letters behind it).  A word takes part as the longer one (m its
length) and as the shorter one (m one more), so it enters ``2 * SEGMENTS`` blocks.  Blocks of more
than ``TILE`` words are cut anew with stretches of one letter; such a block holds at most one word
per letter of the alphabet and one shorter word, so no group grows with the data.

Inside a task the words of many blocks are one padded matrix of code points, and tiles of pairs
are compared column by column.  A pair counts only in the block that holds the end of its common
prefix, so each link is found once and nothing has to be made distinct afterwards.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import map_arrow, stored

MIN_LETTERS = 7
MIN_COUNT = 2
# One occurrence in this many loses a letter, see ``word_counts``.
DELETE_ONE_IN = 31
# A form must be this many times as frequent as its variant.
FORM_RATIO = 10
SEGMENTS = 4
# Words of a block that is not cut any finer; pairs compared in one matrix operation.
TILE = 1024
PAIRS = 1 << 17
# Letters that every word of the common matrix has room for.
USUAL = 64
# Letters are A-Z, a-z and U+00C0 to U+00FF: all of Latin-1's bytes that are not other signs.
_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256)
)


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of letters as Latin-1 bytes (one byte a code point), A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_KEEP).split()


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word`` and ``n``: words of at least ``min_letters`` letters and ``min_count`` occurrences.

    Where ``DELETE_ONE_IN`` divides crc32 of ``<id>:<run>``, the letter at crc32 modulo the run's
    length is left out.  A null id counts as the empty text, a null text holds nothing.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[bytes] = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            start = zlib.crc32(f"{doc_id or ''}:".encode())
            runs = [r for r in runs_of(text) if len(r) >= min_letters]
            for run in runs:
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if not h % DELETE_ONE_IN:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < min_letters:
                        continue
                counts[run] += 1
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counted = map_arrow(rows, count, "word string, n bigint", 8 << 20)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cuts(m: int, pieces: int) -> list[tuple[int, int]]:
    """``pieces`` stretches [begin, end) that tile 0..m, none of them empty."""
    pieces = min(pieces, m)
    ends = [m * (i + 1) // pieces for i in range(pieces)]
    return list(zip([0, *ends[:-1]], ends))


def _keys(word: bytes, m: int, cuts: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(block, begin) of the stretches ``cuts`` for a word that takes part at longer length ``m``."""
    for begin, end in cuts:
        # The begin fixes how many letters come before it, so the text needs no mark between them.
        rest = word[len(word) - (m - end) :]
        yield xxhash.xxh64_intdigest(b"%d,%d,%b%b" % (m, begin, word[:begin], rest)) - (1 << 63), begin


BLOCK_SCHEMA = "block bigint, m int, begin int, word string, n bigint"


def _block_batch(batch: pa.RecordBatch, made: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    block, m, begin, row = np.array(made, np.int64).reshape(-1, 4).T
    rows = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block),
            pa.array(m.astype(np.int32)),
            pa.array(begin.astype(np.int32)),
            batch.column("word").take(rows),
            batch.column("n").take(rows),
        ],
        names=["block", "m", "begin", "word", "n"],
    )


def _into_blocks(words: DataFrame) -> DataFrame:
    """Every word in its blocks of ``SEGMENTS`` stretches."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for row, word in enumerate(w.encode("latin-1") for w in batch.column("word").to_pylist()):
            for m in (len(word), len(word) + 1):
                made += [(block, m, begin, row) for block, begin in _keys(word, m, _cuts(m, SEGMENTS))]
        return _block_batch(batch, made)

    return map_arrow(words.select("word", "n"), spread, BLOCK_SCHEMA, 1 << 18)


def _cut_finer(blocks: DataFrame) -> DataFrame:
    """The rows of large blocks again, with stretches of one letter inside the block's own."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        columns = [batch.column(c).to_pylist() for c in ("word", "m", "begin")]
        for row, (text, m, stretch) in enumerate(zip(*columns)):
            end = next(e for b, e in _cuts(m, SEGMENTS) if b == stretch)
            singles = [(i, i + 1) for i in range(stretch, end)]
            made += [(block, m, begin, row) for block, begin in _keys(text.encode("latin-1"), m, singles)]
        return _block_batch(batch, made)

    return map_arrow(blocks.select("word", "n", "m", "begin"), spread, BLOCK_SCHEMA, 1 << 18)


def _matrix(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with 0 on the right, and the same aligned to the right end."""
    left = np.zeros((len(words), width), np.uint8)
    right = np.zeros((len(words), width), np.uint8)
    for size in set(map(len, words)):
        at = [i for i, w in enumerate(words) if len(w) == size]
        cells = np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), size)
        left[at, :size] = cells
        right[at, width - size :] = cells
    return left, right


def near_pairs(
    words: list[bytes], m: np.ndarray, begin: np.ndarray, groups: np.ndarray, segments: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one edit, tile by tile; rows of one group (sorted by it) share a block."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max())
    left, right = _matrix(words, width)
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    ends = np.r_[starts[1:], len(groups)]
    begin_of = {k: np.array([b for b, _ in _cuts(int(k), segments or int(k))]) for k in np.unique(m)}
    end = np.repeat(ends, ends - starts)
    # Row i meets all later rows of its block: the tile of rows i.. against a stretch of pairs.
    fan = end - np.arange(len(words)) - 1
    upto = np.cumsum(fan)
    first = 0
    while first < len(words):
        base = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, base + PAIRS * 32 // max(32, width), "right")))
        rows = np.arange(first, last)
        a = np.repeat(rows, fan[first:last])
        b = a + 1 + np.arange(len(a)) - np.repeat(upto[first:last] - fan[first:last] - base, fan[first:last])
        first = last
        # At least one has all m letters, else the pair belongs to the block of m - 1.
        both = np.maximum(sizes[a], sizes[b]) == m[a]
        a, b = a[both], b[both]
        same = left[a] == left[b]
        prefix = np.minimum(np.where(same.all(1), width, (~same).argmax(1)), np.minimum(sizes[a], sizes[b]))
        same = (right[a] == right[b])[:, ::-1]
        suffix = np.minimum(np.where(same.all(1), width, (~same).argmax(1)), np.minimum(sizes[a], sizes[b]))
        # One edit: what prefix and suffix leave of the longer word is one letter at most.
        near = (prefix + suffix >= m[a] - 1) & ((sizes[a] != sizes[b]) | (prefix < sizes[a]))
        a, b, prefix = a[near], b[near], prefix[near]
        # The end of the common prefix must lie in this block's stretch.
        home = np.zeros(len(a), bool)
        for k, begins in begin_of.items():
            mine = m[a] == k
            home[mine] = begins[np.searchsorted(begins, np.minimum(prefix[mine], k - 1), "right") - 1] == begin[a[mine]]
        yield a[home], b[home]


def _links(blocks: DataFrame, segments: int | None) -> DataFrame:
    """Per task and word: how many near words, and the best of them (largest n, then smallest word)."""

    def best_of(batch: pa.Table) -> pa.RecordBatch:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        n, m, begin, block = (batch.column(c).to_numpy() for c in ("n", "m", "begin", "block"))
        group = np.cumsum(np.r_[0, (block[1:] != block[:-1]) | (m[1:] != m[:-1]) | (begin[1:] != begin[:-1])])
        # Words of usual length share one matrix; each greater length has its own.
        width = np.maximum(m, USUAL)
        found = []
        for one in np.unique(width):
            at = np.flatnonzero(width == one)
            own = [words[i] for i in at]
            found += [(at[p], at[q]) for p, q in near_pairs(own, m[at].astype(np.int64), begin[at], group[at], segments)]
        a = np.concatenate([p for p, _ in found] or [np.zeros(0, np.int64)])
        b = np.concatenate([q for _, q in found] or [np.zeros(0, np.int64)])
        of, other = np.r_[a, b], np.r_[b, a]
        # Words as numbers in code-point order, so that ties are settled by one sort.
        place = {w: i for i, w in enumerate(sorted(set(words)))}
        number = np.fromiter((place[w] for w in words), np.int64, len(words))
        order = np.lexsort((number[other], -n[other], number[of]))
        of, other = of[order], other[order]
        head = np.flatnonzero(np.r_[True, number[of][1:] != number[of][:-1]]) if len(of) else np.zeros(0, np.int64)
        times = np.diff(np.r_[head, len(of)])
        column = pa.concat_arrays(batch.column("word").chunks)
        return pa.RecordBatch.from_arrays(
            [column.take(pa.array(of[head])), pa.array(times.astype(np.int64)), column.take(pa.array(other[head])), pa.array(n[other[head]].astype(np.int64))],
            names=["word", "n_near", "best", "best_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks arrive in order; the last one of a batch may go on in the next.
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            block = held.column("block").to_numpy()
            cut = int(np.searchsorted(block, block[-1])) if len(block) else 0
            if cut:
                yield best_of(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield best_of(held)

    dealt = blocks.repartition("block").sortWithinPartitions("block", "m", "begin")
    return dealt.mapInArrow(run, "word string, n_near bigint, best string, best_n bigint")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
    tile: int = TILE,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the texts.

    ``form`` is the most frequent near word (ties: the smallest in code-point order) if it is at
    least ``ratio`` times as frequent, else null; ``root`` follows forms to the last.  Frequencies
    grow by ``ratio`` at each step, so chains end and are short.  Null and empty texts hold no
    words, rows that repeat an id count as often as they come, and an empty table gives no rows.
    """
    if min_letters < 1 or ratio < 2:
        raise ValueError("words need a letter and forms a ratio of 2 or more")
    words = stored(word_counts(docs, id_col, text_col, min_letters, min_count), "variant-words")
    blocks = stored(_into_blocks(words), "variant-blocks")
    large = blocks.groupBy("block").agg(F.count("*").alias("rows")).where(F.col("rows") > tile).select("block")
    large = stored(large, "variant-large")
    found = _links(blocks.join(large, "block", "left_anti"), SEGMENTS)
    finer = _cut_finer(blocks.join(large, "block", "left_semi"))
    found = found.unionByName(_links(finer, None))
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    # A whole decimal: ratio times a LONG may pass 64 bits.
    often = -F.col("top.less") >= F.col("n").cast("decimal(19,0)") * ratio
    rows = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(often, F.col("top.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(often, -F.col("top.less")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _last_forms(rows.where("form is not null").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _last_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: pointers doubled in stored rounds until none goes further."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        joined = stored(joined, "variant-roots")
        roots = joined.select("word", "root")
        if not joined.where("moved").limit(1).count():
            return roots
