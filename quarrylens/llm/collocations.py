"""Phrase collocations from weighted acyclic automata.

Texts become shards of word numbers with a sorted word table, stored once.  Each shard turns its
sorted n-grams into a count transducer per prefix range (a range of the hash of the first two
words), and one task per range takes the union and sums the weights.  Counts are exact, because
a phrase is only as frequent as its parts: words are counted first, then pairs of frequent words,
then triples and quadruples whose pairs are all frequent.  What is frequent is handed on as a bit
table of fixed size (``BITS``); a foreign hit costs time, never a result.

The parts of a phrase are looked up by composition: a transducer from part to phrase number is sent
to the range of the part and composed with the counts there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.llm.common import LOWER_BYTES, map_arrow, stored
from quarrylens.llm.transducer import Transducer, from_grams, order_of, union

MIN_COUNT = 30
MAX_WORDS = 4
# Percent of a candidate's count that a longer one must reach to absorb it.
ABSORBED = 80
BEST = 2000
SCORE_UNIT = 2_000_000
NO_LANG = "und"
SHARD_BYTES = 8 << 20
# Bits of the table of frequent words or pairs: 8 MB, whatever the corpus.
BITS = 1 << 26
# Prefix ranges, and words of the corpus for each of them beyond that.
RANGES = 64
RANGE_WORDS = 1 << 24
# N-grams that a range gathers before it takes their union.
HELD = 1 << 20
# A byte that no UTF-8 text holds stands between pieces.
_STOP = b"\xff"
_TABLE = bytes(0xFF if c in b".,;:!?\x0a\x0b\x0c\x0d" else LOWER_BYTES[c] for c in range(256))


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of all texts in order, with ``_STOP`` between pieces and behind each text."""
    return (b" \xff ".join(t.translate(_TABLE) for t in texts)).replace(_STOP, b" \xff ").split()


def word_shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``words`` (sorted, by line), ``ids`` (word number + 1, 0 between pieces), ``n`` words."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        rows = []
        for lang, texts in by_lang.items():
            words = words_of(texts)
            table = sorted(set(words) - {_STOP})
            number = {w: i for i, w in enumerate(table, 1)}
            number[_STOP] = 0
            ids = np.fromiter(map(number.__getitem__, words), np.uint32, len(words))
            rows.append((lang, b"\n".join(table), ids.tobytes(), int((ids > 0).sum())))
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "words", "ids", "n"])

    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    return map_arrow(rows, encode, "lang string, words binary, ids binary, n bigint", SHARD_BYTES)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two words in this order."""
    with np.errstate(over="ignore"):
        mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + np.uint64(0x7F4A7C159E3779B9))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _prefix(hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Hash of the first two words of each n-gram, or of its only word."""
    if grams.shape[1] == 1:
        return hashes[grams[:, 0]]
    two = grams[:, 1] >= 0
    return np.where(two, _pair(hashes[grams[:, 0]], hashes[grams[:, 1]]), hashes[grams[:, 0]])


def _range_of(prefix: np.ndarray, ranges: int) -> np.ndarray:
    return ((prefix >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)


def _has(bits: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    at = (prefix & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _count(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(ids, return_counts=True)
    return values, counts


def shard_grams(ids: np.ndarray, n_words: int, hashes: np.ndarray, level: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams of one shard with their counts: words (1), frequent pairs (2), all longer ones (3)."""
    word = ids.astype(np.int64) - 1
    if level == 1:
        values, counts = _count(word[word >= 0])
        return values[:, None].astype(np.int32), counts
    if level == 2:
        frequent = np.r_[_has(bits, hashes), False]
        good = frequent[word]
        at = np.flatnonzero(good[:-1] & good[1:])
        values, counts = _count(word[at] * n_words + word[at + 1])
        return np.stack([values // n_words, values % n_words], 1).astype(np.int32), counts
    at = np.flatnonzero((word[:-1] >= 0) & (word[1:] >= 0))
    pair = np.zeros(len(word), bool)
    pair[at] = _has(bits, _pair(hashes[word[at]], hashes[word[at + 1]]))
    found, weights = [], []
    # Positions where the next ``size - 1`` pairs are frequent; each size numbers its n-grams for the next.
    begin = np.flatnonzero(pair)
    number = word[begin] * n_words + word[begin + 1]
    table, number = np.unique(number, return_inverse=True)
    grams = np.stack([table // n_words, table % n_words], 1)
    for size in range(3, MAX_WORDS + 1):
        keep = begin + size - 1 < len(word)
        keep[keep] = pair[begin[keep] + size - 2]
        begin, number = begin[keep], number[keep]
        table, number, counts = np.unique(number * n_words + word[begin + size - 1], return_inverse=True, return_counts=True)
        grams = np.c_[grams[table // n_words], table % n_words]
        padded = np.full((len(grams), MAX_WORDS), -1, np.int32)
        padded[:, :size] = grams
        found.append(padded)
        weights.append(counts)
    every, weight = np.concatenate(found), np.concatenate(weights)
    order = order_of(every, n_words)
    return every[order], weight[order]


DEPTH = {1: 1, 2: 2, 3: MAX_WORDS}
RANGE_SCHEMA = "lang string, part int, counts binary"


def _by_range(lang: str, table: list[bytes], grams: np.ndarray, weights: np.ndarray, prefix: np.ndarray, ranges: int) -> pa.RecordBatch:
    """One transducer per prefix range of sorted n-grams."""
    part = _range_of(prefix, ranges)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]) if len(part) else []
    made = [at for at in np.split(order, cuts[1:])] if len(part) else []
    blobs = [from_grams(table, grams[at], weights[at]).to_bytes() for at in made]
    parts = [int(part[at[0]]) for at in made]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(made), pa.string()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["lang", "part", "counts"]
    )


def _level(shards: DataFrame, level: int, ranges: int, min_count: int, bits: np.ndarray | None) -> DataFrame:
    """Count transducers per language and prefix range; n-grams below ``min_count`` are left out."""
    depth = DEPTH[level]
    shared = None if bits is None else shards.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, ids in zip(*[c.to_pylist() for c in batch.columns]):
                table = words.split(b"\n") if words else []
                if not table:
                    continue
                hashes = _hashes(lang, table)
                grams, weights = shard_grams(np.frombuffer(ids, "<u4"), len(table), hashes, level, shared and shared.value)
                yield _by_range(lang, table, grams, weights, _prefix(hashes, grams), ranges)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def result() -> pa.RecordBatch:
            blob = union(held, depth, min_count).to_bytes()
            columns = [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int32()), pa.array([blob], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "part", "counts"])

        for batch in batches:
            for lang, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if key is not None and key != (lang, part):
                    yield result()
                    held, size = [], 0
                key = (lang, part)
                held.append(Transducer.from_bytes(blob.as_py()))
                size += len(held[-1].label)
                if size > HELD and len(held) > 1:
                    held = [union(held, depth)]
                    # A union that stays large waits for as much again.
                    size = len(held[0].label) // 2
        if key is not None:
            yield result()

    pieces = shards.select("lang", "words", "ids").mapInArrow(count, RANGE_SCHEMA)
    dealt = pieces.repartition("lang", "part").sortWithinPartitions("lang", "part")
    return stored(dealt.mapInArrow(merge, RANGE_SCHEMA), f"phrases-{level}")


def _frequent_bits(counts: DataFrame, level: int) -> np.ndarray:
    """The bit table of all n-grams of a level: at most BITS bits reach the driver, in rows of 4 KB."""

    def slots(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.zeros(0, np.int64)]
        for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            counted = Transducer.from_bytes(blob.as_py())
            grams, _ = counted.grams(DEPTH[level])
            # Spark numbers bits from 1.
            found.append((_prefix(_hashes(lang, counted.labels), grams) & np.uint64(BITS - 1)).astype(np.int64) + 1)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["slot"])

    slot = map_arrow(counts.select("lang", "counts"), slots, "slot bigint")
    rows = (
        slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    out = np.zeros(BITS // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


LOOKUP_SCHEMA = "lang string, part int, level int, query binary, starts array<bigint>, phrase array<string>, a array<bigint>, k array<int>, head array<boolean>"
PART_SCHEMA = "lang string, phrase string, a bigint, k int, head boolean, f bigint"


def _lookups(counts: DataFrame, ranges: int) -> DataFrame:
    """For each candidate and cut, both parts: transducers from part to a row of (phrase, a, k, side).

    They go to the range of the part and to the level (words, pairs, longer) that counts it.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                counted = Transducer.from_bytes(blob.as_py())
                grams, weights = counted.grams(MAX_WORDS)
                size = (grams >= 0).sum(1)
                phrases = np.array([b" ".join(counted.labels[i] for i in g[:s]).decode("utf-8", "replace") for g, s in zip(grams.tolist(), size)], object)
                parts, rows, cuts, heads = [], [], [], []
                for n in range(2, MAX_WORDS + 1):
                    at = np.flatnonzero(size == n)
                    for k in range(1, n):
                        for head in (True, False):
                            part = np.full((len(at), MAX_WORDS), -1, np.int32)
                            chosen = grams[at, :k] if head else grams[at, k:n]
                            part[:, : chosen.shape[1]] = chosen
                            parts.append(part)
                            rows.append(at)
                            cuts.append(np.full(len(at), k))
                            heads.append(np.full(len(at), head))
                part, row, cut, head = (np.concatenate(x) for x in (parts, rows, cuts, heads))
                if not len(part):
                    continue
                order = order_of(part, len(counted.labels))
                part, row, cut, head = part[order], row[order], cut[order], head[order]
                target = _range_of(_prefix(_hashes(lang, counted.labels), part), ranges)
                target = 4 * target + np.minimum((part >= 0).sum(1), 3)
                for one in np.unique(target).tolist():
                    at = np.flatnonzero(target == one)
                    # Equal parts are one question with several askers.
                    new = np.r_[True, (part[at][1:] != part[at][:-1]).any(1)]
                    starts = np.flatnonzero(new)
                    query = from_grams(counted.labels, part[at[new]], starts)
                    asked = row[at]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang], pa.string()),
                            pa.array([one // 4], pa.int32()),
                            pa.array([one % 4], pa.int32()),
                            pa.array([query.to_bytes()], pa.binary()),
                            pa.array([starts.tolist()], pa.list_(pa.int64())),
                            pa.array([phrases[asked].tolist()], pa.list_(pa.string())),
                            pa.array([weights[asked].tolist()], pa.list_(pa.int64())),
                            pa.array([cut[at].tolist()], pa.list_(pa.int32())),
                            pa.array([head[at].tolist()], pa.list_(pa.bool_())),
                        ],
                        names=["lang", "part", "level", "query", "starts", "phrase", "a", "k", "head"],
                    )

    return counts.select("lang", "counts").mapInArrow(ask, LOOKUP_SCHEMA)


def _answers(lookups: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of the parts: each question composed with the count transducers of its range."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counted = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["counts"] != last:
                    last, counted = row["counts"], Transducer.from_bytes(row["counts"])
                first, f = Transducer.from_bytes(row["query"]).compose(counted, MAX_WORDS)
                if not len(first):
                    continue
                order = np.argsort(first)
                # A question's askers go from its first row to that of the next question.
                starts, total = row["starts"], len(row["phrase"])
                first, f = first[order], f[order]
                ends = np.append(starts, total)[np.searchsorted(starts, first, "right")]
                at = np.concatenate([np.arange(b, e) for b, e in zip(first, ends)])
                times = np.repeat(f, ends - first)
                phrase, a, k, head = (pa.array(row[c], t) for c, t in (("phrase", pa.string()), ("a", pa.int64()), ("k", pa.int32()), ("head", pa.bool_())))
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(at), pa.string()), *[c.take(taken) for c in (phrase, a, k, head)], pa.array(times)],
                    names=["lang", "phrase", "a", "k", "head", "f"],
                )

    joined = lookups.join(counts, ["lang", "part", "level"]).select("lang", "query", "starts", "phrase", "a", "k", "head", "counts")
    return joined.mapInArrow(answer, PART_SCHEMA)


def _big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    absorbed: int = ABSORBED,
    best: int = BEST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of two to four words per language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the
    language.  A null language is ``und``, a null text empty; repeated rows count as often as they
    come, and an empty table gives no rows.  Candidates inside a longer one that occurs at least
    ``absorbed`` percent as often are left out.
    """
    shards = stored(word_shards(docs, text_col, lang_col), "phrase-shards")
    words = shards.agg(F.sum("n").alias("n")).first()["n"] or 0
    ranges = max(RANGES, words // RANGE_WORDS)
    single = _level(shards, 1, ranges, min_count, None)
    pairs = _level(shards, 2, ranges, min_count, _frequent_bits(single, 1))
    longer = _level(shards, 3, ranges, min_count, _frequent_bits(pairs, 2))
    levels = [df.withColumn("level", F.lit(i)) for i, df in enumerate((single, pairs, longer), 1)]
    every = levels[0].unionByName(levels[1]).unionByName(levels[2])
    parts = stored(_answers(_lookups(pairs.unionByName(longer), ranges), every), "phrase-parts")
    cuts = parts.groupBy("lang", "phrase", "k").agg(
        F.max("a").alias("a"), F.max(F.when(F.col("head"), F.col("f"))).alias("l"), F.max(F.when(~F.col("head"), F.col("f"))).alias("r")
    )
    # Decimals of up to 38 digits: 2,000,000 times a count may pass 64 bits; DIV keeps the whole part.
    cuts = cuts.withColumn("up", _big("a") * F.lit(SCORE_UNIT).cast("decimal(8,0)")).withColumn("down", _big("l") + _big("r"))
    weakest = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut")
    candidates = stored(
        cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"),
        "phrase-candidates",
    )
    split = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")),
        )
    )
    outer = (
        candidates.select("lang", split.alias("words"), "a").where(F.size("words") > 2)
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    )
    kept = candidates.join(outer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (_big("around") * 100 < _big("a") * absorbed)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS v(s)
), grams AS MATERIALIZED (
  SELECT lang, s, array_to_string(list_slice(w, i, i + s - 1), ' ') AS g, count(*) AS f FROM places GROUP BY ALL
), candidates AS MATERIALIZED (
  SELECT lang, s, g, string_split(g, ' ') AS w, f FROM grams WHERE s > 1 AND f >= 30
), cuts AS MATERIALIZED (
  SELECT lang, g, f AS a, k,
    array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, s), ' ') AS tail
  FROM (SELECT *, unnest(range(1, s)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.g, c.a, c.k, h.f AS l, t.f AS r, 2000000 * c.a::HUGEINT // (h.f + t.f) AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.g = c.head JOIN grams t ON t.lang = c.lang AND t.g = c.tail
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g, max(f) AS around
  FROM (SELECT *, unnest(range(1, s - n + 2)) AS i FROM (SELECT *, unnest(range(2, s)) AS n FROM candidates))
  GROUP BY ALL
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inner_parts p ON p.lang = w.lang AND p.g = w.g
  WHERE p.around IS NULL OR 100 * p.around < 80 * w.a
), ranked AS (
  SELECT *, g AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
