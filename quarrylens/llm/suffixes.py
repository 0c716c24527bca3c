"""Exact removal of long repeated byte strings: a sparse, partitioned suffix array.

A string of ``length`` bytes repeats when another document with a smaller id holds it too.  Not
every suffix has to be sorted to see this: of the ``length - gram + 1`` grams inside a string the
one with the least hash is its anchor, decided by the string's bytes alone, so two occurrences
share the anchor at the same place.  Only suffixes that begin at an anchor take part:

1. Sampled splitters cut the suffixes into ranges by their leading bytes.  Each range learns
   which anchors occur in more than one document.
2. The documents cut the surroundings of these anchors (everything a string around the anchor can
   hold) and send them to the same ranges.  A range sorts its strings, 8 bytes at a time, and
   compares neighbours; the smallest id of each run of equal strings tells which are repeats.
   A string never spans two ranges, because equal strings have equal anchors.
3. Repeats go back to their documents as byte ranges.

Before each shuffle a task answers what it can see itself: of equal anchors or surroundings in its
block of documents only the one with the smallest id travels.  A group of copies is therefore one
row per block of documents in its range, not one per copy.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import stored

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 18
RANGE_BYTES = 8 << 20
# Ranges that even a small input is cut into.
LEAST_RANGES = 128
SAMPLE_KEYS = 1 << 16
# Above the size of any surrounding.
_SIZE = 1 << 24

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D


def _bytes_table() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * _MIX
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


_TABLE = _bytes_table()


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every run of ``width`` bytes along the last axis, by doubling."""
    part, size = _TABLE[data], 1
    whole, done = None, 0
    while True:
        if width & size:
            if whole is None:
                whole, done = part, size
            else:
                n = data.shape[-1] - done - size + 1
                whole = whole[..., :n] * _power(size) + part[..., done : done + n]
                done += size
        if size * 2 > width:
            break
        n = data.shape[-1] - 2 * size + 1
        part = part[..., :n] * _power(size) + part[..., size : size + n]
        size *= 2
    whole = whole ^ (whole >> np.uint64(31))
    whole *= _MIX
    return whole ^ (whole >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Best of every run of ``width`` values, by doubling."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings inside documents that end at ``ends``."""
    n, run = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = rolling(data, gram) | np.uint64(1)
    least = _sliding(grams, run, np.minimum)
    # Strings across the end of a document do not count; 0 equals no hash.
    for end in ends[:-1].tolist():
        least[max(0, end - length + 1) : end] = 0
    border = np.zeros(run - 1, np.uint64)
    most = _sliding(np.concatenate([border, least, border]), run, np.maximum)
    at = np.flatnonzero(most == grams)
    return at, grams[at]


def block_anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document number, place, 48-bit hash, order key) of the anchors of many documents.

    The key orders by up to six leading bytes of the suffix, then by hash.
    """
    out = []
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= PIECE_BYTES):
            size += len(texts[last])
            last += 1
        data = np.frombuffer(b"".join(texts[first:last]), np.uint8)
        ends = np.cumsum([len(t) for t in texts[first:last]])
        at, hashes = anchors(data, ends, length, gram)
        doc = np.searchsorted(ends, at, side="right")
        key = np.zeros(len(at), np.uint64)
        for i in range(6):
            key = key << np.uint64(8) | (data[at + i] if i < gram else np.uint64(0))
        key = key << np.uint64(16) | hashes >> np.uint64(48)
        out.append((first + doc, at - (ends - [len(t) for t in texts[first:last]])[doc] if len(at) else at, hashes >> np.uint64(16), key))
        first = last
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(part) for part in zip(*out))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, protocol=5), 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.decompress(blob))


def _small(values: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, byte by byte: most of the upper bytes are 0 and pack away."""
    return np.ascontiguousarray(np.diff(values, prepend=values[:0].dtype.type(0)).view(np.uint8).reshape(-1, 8).T)


def _large(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows in order, in runs of about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        step = max(1, batch.num_rows * (1 << 20) // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _column(parts: list[pa.RecordBatch], at: int) -> list:
    return [x for part in parts for x in part.column(at).to_pylist()]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by the keys (first one leads) and, in that order, where a new key begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, new


def _answers(ids: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """Rows (doc_id, numbers): the values of each id as one list, side by side."""
    order = np.argsort(ids, kind="stable")
    ids, table = ids[order], np.stack([v[order].astype(np.int64) for v in values], axis=1)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]]) if len(ids) else np.zeros(1, np.int64)
    lists = pa.ListArray.from_arrays(pa.array((cuts * len(values)).astype(np.int32)), pa.array(table.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(ids[cuts[:-1]].astype(np.int64)), lists], names=["doc_id", "numbers"])


# Rows between the stages: a range number and a packed message, or answers passed along.
MESSAGE = "range_id bigint, blob binary, doc_id bigint, numbers array<bigint>"
ANSWER = "doc_id bigint, numbers array<bigint>"
_LIST = pa.list_(pa.int64())


def _messages(ranges: np.ndarray, blobs: list[bytes], ready: pa.RecordBatch) -> pa.RecordBatch:
    """Packed messages for their ranges; ready answers spread over ranges by id."""
    n, m = len(blobs), ready.num_rows
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(ranges, pa.int64()), pa.array(-1 - ready.column(0).to_numpy() % 4096, pa.int64())]),
            pa.concat_arrays([pa.array(blobs, pa.binary()), pa.nulls(m, pa.binary())]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), ready.column(0)]),
            pa.concat_arrays([pa.nulls(n, _LIST), ready.column(1).cast(_LIST)]),
        ],
        names=["range_id", "blob", "doc_id", "numbers"],
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept`` (BINARY) for every row.

    Each byte is removed that lies in a string of ``length`` bytes which also starts in a document
    with a smaller id.  Overlaps count, strings are those of the input, matches never cross
    documents, and repeats inside one document alone stay.  A null text is empty.  A row with a
    null id neither loses bytes nor makes others lose any.  Rows that repeat an id are expected to
    repeat the text: they are one document for the others and each is returned.  Empty tables give
    empty results.  Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"))
    named = rows.where(F.col("doc_id").isNotNull() & (F.length("body") >= length))
    splitters = _splitters(named, length, gram)
    shared = _shared_anchors(named, splitters, length, gram)
    per_doc = shared.groupBy("doc_id").agg(F.flatten(F.collect_list("numbers")).alias("numbers"))
    repeats = stored(_repeats(_zipped(named).join(per_doc, "doc_id"), splitters, length, gram), "suffix-repeats")
    spans = repeats.groupBy("doc_id").agg(F.flatten(F.collect_list("numbers")).alias("numbers"))
    spans = spans.withColumnRenamed("doc_id", "span_id")
    joined = _zipped(rows).join(spans, F.col("doc_id") == F.col("span_id"), "left").select("doc_id", "body", "numbers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, 1 << 20):
            found = []
            for part in parts:
                for i, (doc, body) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    text = zstandard.decompress(body) if body else b""
                    numbers = part.column(2)[i]
                    spans_of = numbers.values.to_numpy().reshape(-1, 2) if numbers.is_valid else np.zeros((0, 2), np.int64)
                    found.append((doc, *without(text, spans_of)))
            doc, size, removed, count, kept = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (doc, size, removed, count)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    out = joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.withColumnRenamed("doc_id", id_col)


def without(text: bytes, spans: np.ndarray) -> tuple[int, int, int, bytes]:
    """Bytes of the text, removed, runs removed, and what is left."""
    if not len(spans):
        return len(text), 0, 0, text
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    begins = spans[new, 0]
    stops = np.minimum(np.concatenate([reach[:-1][new[1:]], reach[-1:]]), len(text))
    edges = [0, *np.stack([begins, stops], axis=1).ravel().tolist(), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return len(text), len(text) - len(kept), len(begins), kept


def _zipped(rows: DataFrame) -> DataFrame:
    """Bodies compressed, so that shuffles carry less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for parts in _blocks(batches, 1 << 20):
            bodies = [pack.compress(b) if b else b"" for b in _column(parts, 1)]
            ids = pa.array(_column(parts, 0), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(bodies, pa.binary())], names=["doc_id", "body"])

    return rows.mapInArrow(run, "doc_id bigint, body binary")


def _splitters(rows: DataFrame, length: int, gram: int) -> np.ndarray:
    """Order keys that cut the suffixes into ranges of about ``RANGE_BYTES`` of text.

    One document in 64, by hash, gives keys; at most ``SAMPLE_KEYS`` of them reach the driver.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, 1 << 20):
            *_, key = block_anchors(_column(parts, 0), length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    total = rows.agg(F.sum(F.length("body").cast("bigint"))).first()[0] or 0
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(64)) == 0).select("body").mapInArrow(keys, "key bigint")
    sample = some.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_KEYS).toArrow()["key"].to_numpy().view(np.uint64)
    ranges = int(min(max(LEAST_RANGES, total // RANGE_BYTES), SAMPLE_KEYS))
    sample = np.sort(sample)
    return np.unique(sample[np.linspace(0, len(sample), ranges, endpoint=False).astype(int)[1:]]) if len(sample) else sample


def _shared_anchors(rows: DataFrame, splitters: np.ndarray, length: int, gram: int) -> DataFrame:
    """(doc_id, numbers): hashes of the anchors that a document shares with another one."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, BLOCK_BYTES):
            ids = np.array(_column(parts, 0), np.int64)
            doc, _, hashes, key = block_anchors(_column(parts, 1), length, gram)
            owner = ids[doc]
            order, new = _groups(hashes, owner)
            order = order[new]
            hashes, owner, key = hashes[order], owner[order], key[order]
            first = np.ones(len(hashes), bool)
            first[1:] = hashes[1:] != hashes[:-1]
            group = np.cumsum(first) - 1
            several = np.bincount(group, minlength=len(hashes[first]))[group] > 1
            ready = _answers(owner[several], hashes[several])
            # One row per hash travels; 'known' tells that its documents have their answer.
            hashes, owner, key, known = hashes[first], owner[first], key[first], several[first]
            place = np.searchsorted(splitters, key, side="right")
            order = np.lexsort((hashes, place))
            cuts = np.flatnonzero(np.diff(place[order])) + 1
            ranges, blobs = [], []
            for run in np.split(order, cuts) if len(order) else []:
                docs_, index = np.unique(owner[run], return_inverse=True)
                ranges.append(place[run[0]])
                blobs.append(_pack(_small(hashes[run]), docs_, index.astype(np.uint32), np.packbits(known[run])))
            yield _messages(np.array(ranges, np.int64), blobs, ready)

    def match(group: pa.Table) -> pa.Table:
        answers = [_passed(group)]
        hashes, owner, known = [], [], []
        for blob in group["blob"].drop_null().to_pylist():
            planes, docs_, index, bits = _unpack(blob)
            hashes.append(_large(planes))
            owner.append(docs_[index])
            known.append(np.unpackbits(bits, count=len(index)).astype(bool))
        if hashes:
            hashes, owner, known = map(np.concatenate, (hashes, owner, known))
            order, new = _groups(hashes)
            which = np.cumsum(new) - 1
            low = np.minimum.reduceat(owner[order], np.flatnonzero(new))
            high = np.maximum.reduceat(owner[order], np.flatnonzero(new))
            more = (low != high) | np.logical_or.reduceat(known[order], np.flatnonzero(new))
            tell = order[more[which] & ~known[order]]
            answers.append(pa.Table.from_batches([_answers(owner[tell], hashes[tell])]))
        return pa.concat_tables(answers)

    sent = rows.mapInArrow(send, MESSAGE)
    return sent.groupBy("range_id").applyInArrow(match, ANSWER)


def _passed(group: pa.Table) -> pa.Table:
    """Answers that only travel with the messages."""
    return group.select(["doc_id", "numbers"]).filter(pa.compute.is_valid(group["doc_id"])).cast(
        pa.schema([("doc_id", pa.int64()), ("numbers", _LIST)])
    )


def _repeats(docs: DataFrame, splitters: np.ndarray, length: int, gram: int) -> DataFrame:
    """(doc_id, numbers): begin and end, in turn, of byte ranges to remove."""
    side = length - gram
    width = length + side

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, BLOCK_BYTES // 4):
            ids = np.array(_column(parts, 0), np.int64)
            texts = [zstandard.decompress(b) for b in _column(parts, 1)]
            lists = [part.column(2)[i].values.to_numpy() for part in parts for i in range(part.num_rows)]
            doc, at, hashes, key = block_anchors(texts, length, gram)
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            wanted = np.zeros(len(doc), bool)
            for i, told in enumerate(lists):
                a, b = bounds[i], bounds[i + 1]
                wanted[a:b] = np.isin(hashes[a:b], told.view(np.uint64))
            doc, at, hashes, key = doc[wanted], at[wanted], hashes[wanted], key[wanted]
            sizes = np.array([len(t) for t in texts], np.int64)
            offset = np.cumsum(sizes) - sizes
            data = np.concatenate([np.frombuffer(b"".join(texts), np.uint8), np.zeros(width, np.uint8)])
            begin, end = np.maximum(0, at - side), np.minimum(sizes[doc], at + length)
            cut = np.lib.stride_tricks.sliding_window_view(data, width)[offset[doc] + begin]
            cut = np.where(np.arange(width) < (end - begin)[:, None], cut, 0).astype(np.uint8)
            owner, shape = ids[doc], (at - begin) * _SIZE + end - begin
            order, new = _equal_rows(cut, shape, owner)
            # In a run of equal surroundings: the smallest id travels, the others are repeats.
            which = np.cumsum(new) - 1
            smallest = owner[order][new][which]
            later = owner[order] > smallest
            late, rest = order[later], order[~later]
            ready = _answers(*_merged(owner[late], begin[late], end[late]))
            heads = order[new]
            place = np.searchsorted(splitters, key[heads], side="right")
            entry_of, by_place = which[~later], np.argsort(place, kind="stable")
            cuts = np.flatnonzero(np.diff(place[by_place])) + 1
            rank = np.empty(len(heads), np.int64)
            ranges, blobs = [], []
            entry_place = place[entry_of] if len(entry_of) else entry_of
            entry_order = np.argsort(entry_place, kind="stable")
            entry_ends = np.searchsorted(entry_place[entry_order], np.arange(len(splitters) + 2))
            for run in np.split(by_place, cuts) if len(by_place) else []:
                number = int(place[run[0]])
                rank[run] = np.arange(len(run))
                some = entry_order[entry_ends[number] : entry_ends[number + 1]]
                ranges.append(number)
                head = heads[run]
                blobs.append(
                    _pack(hashes[head], shape[head], owner[head], cut[head], rank[entry_of[some]], begin[rest[some]])
                )
            yield _messages(np.array(ranges, np.int64), blobs, ready)

    def match(group: pa.Table) -> pa.Table:
        answers = [_passed(group)]
        parts = [_unpack(blob) for blob in group["blob"].drop_null().to_pylist()]
        if parts:
            shift = np.cumsum([0, *(len(p[0]) for p in parts)])
            entry = np.concatenate([p[4] + s for p, s in zip(parts, shift)])
            begin = np.concatenate([p[5] for p in parts])
            hashes, shape, owner, cut = (np.concatenate([p[i] for p in parts]) for i in range(4))
            found = compare(hashes, shape, owner, cut, length)
            seg, a, b = found
            # Every place of a string's surroundings has the same repeats.
            order = np.argsort(seg, kind="stable")
            seg, a, b = seg[order], a[order], b[order]
            first, last = np.searchsorted(seg, entry), np.searchsorted(seg, entry, side="right")
            counts = last - first
            hit = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            doc, base = np.repeat(owner[entry], counts), np.repeat(begin, counts)
            answers.append(pa.Table.from_batches([_answers(*_merged(doc, base + a[hit], base + b[hit]))]))
        return pa.concat_tables(answers)

    sent = docs.select("doc_id", "body", "numbers").sortWithinPartitions("doc_id").mapInArrow(send, MESSAGE)
    return sent.groupBy("range_id").applyInArrow(match, ANSWER)


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as 8-byte numbers, in an order that sorts like the bytes."""
    pad = -rows.shape[1] % 8
    full = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad))))
    return list(full.view(">u8").astype(np.uint64).T)


def _equal_rows(rows: np.ndarray, shape: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal surroundings together, smallest id first, and where each begins."""
    quick = np.zeros(len(rows), np.uint64)
    words = _words(rows)
    for word in words:
        quick = (quick ^ word) * _MIX
        quick ^= quick >> np.uint64(32)
    order = np.lexsort((owner, shape, quick))
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in (quick, shape, *words):
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, new


def compare(
    hashes: np.ndarray, shape: np.ndarray, owner: np.ndarray, cut: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the parts of each surrounding that repeat a smaller id's string.

    Equal surroundings are settled as a whole.  Anchors with several different surroundings go on
    to single strings: those with a hash of their own cannot repeat, the rest are sorted by their
    bytes, 8 at a time, and neighbours compared.
    """
    size = shape % _SIZE
    order, new = _equal_rows(cut, shape, owner)
    which = np.cumsum(new) - 1
    heads = order[new]
    low = owner[heads]
    full = order[owner[order] > low[which]]
    rows, begins, ends = [full], [np.zeros(len(full), np.int64)], [size[full]]

    _, group, counts = np.unique(hashes[heads], return_inverse=True, return_counts=True)
    mixed = heads[counts[group] > 1]
    if len(mixed):
        found = []
        for at in range(0, len(mixed), 1 << 16):
            some = mixed[at : at + (1 << 16)]
            quick = rolling(cut[some], length)
            inside = np.arange(quick.shape[1]) <= (size[some] - length)[:, None]
            row, place = np.nonzero(inside)
            found.append((some[row], place, quick[row, place]))
        row, place, quick = (np.concatenate(part) for part in zip(*found))
        order = np.argsort(quick, kind="stable")
        same = quick[order][1:] == quick[order][:-1]
        twin = np.zeros(len(order), bool)
        twin[1:] |= same
        twin[:-1] |= same
        row, place = row[order[twin]], place[order[twin]]
        if len(row):
            strings = np.lib.stride_tricks.sliding_window_view(cut, length, axis=1)[row, place]
            words = _words(strings)
            order = np.lexsort((owner[row], *words[::-1]))
            new = np.ones(len(order), bool)
            new[1:] = False
            for word in words:
                k = word[order]
                new[1:] |= k[1:] != k[:-1]
            smallest = owner[row[order]][new][np.cumsum(new) - 1]
            hit = order[owner[row[order]] > smallest]
            # Only the first owner of a surrounding is asked here; copies are settled above.
            rows.append(row[hit])
            begins.append(place[hit])
            ends.append(place[hit] + length)
    return _merged(np.concatenate(rows), np.concatenate(begins), np.concatenate(ends))


def _merged(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each owner without overlaps."""
    if not len(owner):
        return owner, begin, end
    order = np.lexsort((begin, owner))
    owner, begin, end = owner[order], begin[order], end[order]
    change = np.concatenate([[True], owner[1:] != owner[:-1]])
    # Shift owners apart, so that one running maximum serves all of them.
    lift = (np.cumsum(change) - 1) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (begin + lift)[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(owner) - 1]])
    return owner[new], begin[new], (reach - lift)[last]
