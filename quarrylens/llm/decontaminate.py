"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides hash every k-gram of words and keep the minimum of each run of ``window - k + 1``
k-grams.  A window of ``window`` words has exactly one such minimum, decided by its words alone,
so every window that a document shares with an item shares its fingerprint: none is missed.
Fingerprint hits are extended to whole windows and compared as words, so none is invented.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import lower_ascii, stored

WINDOW = 10
GRAM = 5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), NOT_WORD), "")


def _starts(n: Column, width: int) -> Column:
    """0 .. n - width; empty when the text is shorter."""
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def _minima(with_words: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``minima``: for each window of words the least hash of its k-grams."""
    hashed = with_words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn(
        "grams",
        F.transform(
            _starts(F.size("hashes"), gram),
            lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(gram)]),
        ),
    )
    run = window - gram + 1
    return grams.withColumn(
        "minima", F.transform(_starts(F.size("grams"), run), lambda i: F.array_min(F.slice("grams", i + 1, run)))
    ).drop("hashes", "grams")


def _short_spans(width: int) -> Column:
    """Every run of ``width`` words as a run of one window, with the print of a short item."""
    return F.transform(
        _starts(F.size("words"), width),
        lambda i: F.struct(
            i.alias("first"),
            (i + 1).alias("behind"),
            F.lit(width).alias("width"),
            F.xxhash64(F.lit(width), F.array_join(F.slice("words", i + 1, width), " ")).alias("print"),
        ),
    )


def _windows(width: Column | int, starts: Column) -> Column:
    """(start, width, words joined by a space) for the given starts."""
    return F.transform(
        starts,
        lambda s: F.struct(
            s.alias("start"), F.lit(width).alias("width"), F.array_join(F.slice("words", s + 1, F.lit(width)), " ").alias("gram")
        ),
    )


def benchmark_windows(items: DataFrame, item_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``item_id, width, gram, print``: every window of every item with its fingerprint.

    An item with fewer words is one window of all its words; its fingerprint is their hash.
    """
    rows = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("words"))
    long = _minima(rows.where(F.size("words") >= window), window, gram).select(
        "item_id", F.explode(F.arrays_zip(_windows(window, _starts(F.size("words"), window)).alias("w"), F.col("minima").alias("m"))).alias("x")
    )
    long = long.select("item_id", "x.w.width", "x.w.gram", F.col("x.m").alias("print"))
    n = F.size("words")
    short = rows.where((n > 0) & (n < window)).select(
        "item_id", n.alias("width"), F.array_join("words", " ").alias("gram")
    )
    short = short.withColumn("print", F.xxhash64("width", "gram"))
    return long.union(short).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    Null and empty texts have no words and no hits.  An item that occurs twice counts once; items
    with a null id mark words but are not in the list.  Rows that repeat an id are expected to
    repeat its text: each is returned, with the hits of all of them together; so are null ids.
    The benchmark tables are stored first, so the planner knows their true size: it sends them to
    the tasks while they are under its broadcast limit and joins by shuffle otherwise.
    """
    bench = stored(benchmark_windows(items, item_col, item_text_col, window, gram), "bench-windows")
    prints = bench.select("print", "width").distinct()
    # At most window - 1 numbers.
    short = sorted(r["width"] for r in bench.where(F.col("width") < window).select("width").distinct().collect())

    rows = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words"))
    mined = _minima(rows, window, gram)
    # Runs of windows with one minimum: (first, behind the last, minimum).
    edges = F.filter(
        F.sequence(F.lit(0), F.size("minima")),
        lambda i: (i == 0) | ~F.get("minima", i).eqNullSafe(F.get("minima", i - 1)),
    )
    runs = F.transform(
        F.filter("edges", lambda i: i < F.size("minima")),
        lambda i, k: F.struct(
            i.alias("first"), F.get("edges", k + 1).alias("behind"), F.lit(window).alias("width"), F.get("minima", i).alias("print")
        ),
    )
    spans = F.concat(runs, *[_short_spans(width) for width in short])
    runs_of = mined.withColumn("edges", edges).select("doc_id", F.inline(spans))
    hits = runs_of.join(prints, ["print", "width"], "left_semi")
    per_doc = hits.groupBy("doc_id").agg(F.collect_set(F.struct("first", "behind", "width")).alias("spans"))

    # Extend: all windows of the hit runs, as words, compared with the items' windows.
    per_doc = per_doc.withColumnRenamed("doc_id", "hit_id")
    joined = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left"
    )
    joined = joined.withColumn("words", words(F.col("text")))
    whole = F.flatten(
        F.transform(
            F.filter("spans", lambda s: s["first"] + s["width"] <= F.size("words")),
            lambda s: _windows(s["width"], F.sequence(s["first"], F.least(s["behind"], F.size("words") - s["width"] + 1) - 1)),
        )
    )
    found = stored(
        joined.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.when(F.col("spans").isNotNull(), whole).alias("windows")),
        "bench-found",
    )
    seen = found.select("doc_id", F.inline("windows")).join(bench.select("width", "gram").distinct(), ["width", "gram"], "left_semi")
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["width"] - 1)))
    n_hit = (
        seen.groupBy("doc_id")
        .agg(F.collect_set(F.struct("start", "width")).alias("hits"))
        .select("doc_id", F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"))
    )
    item_names = F.collect_set(F.col("item_id").cast("string"))
    per_item = (
        seen.select("doc_id", "width", "gram").distinct().join(bench.drop("print"), ["width", "gram"])
        .groupBy("doc_id").agg(F.array_sort(item_names).alias("items"))
    )
    marks = n_hit.join(per_item, n_hit["doc_id"].eqNullSafe(per_item["doc_id"])).select(
        n_hit["doc_id"].alias("hit_id"), "n_hit", "items"
    )
    out = found.select("doc_id", "n_words").join(marks, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left")
    items_text = F.coalesce(F.array_join("items", ","), F.lit(""))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select(
        F.col("doc_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(items_text, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that share no window with a benchmark item, with their columns.

    A hit depends on the text alone, so texts are marked, by digest: rows with a null id and rows
    that repeat an id with another text are judged each by its own text.  Null texts stay.
    """
    name = "_digest"
    while name in map(str.lower, docs.columns):
        name += "_"
    # A column of its own, so that the join does not hash a text again for each comparison.
    marked = docs.withColumn(name, F.unhex(F.sha2("text", 256)))
    texts = marked.where(F.col("text").isNotNull()).select(F.col(name).alias("doc_id"), "text")
    bad = contamination(texts, items).where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return marked.join(bad, name, "left_anti").drop(name)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, width, array_to_string(w[s : s + width - 1], ' ') AS gram FROM (
    SELECT item_id, w, least(10, len(w)) AS width, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s
    FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, width, array_to_string(w[s : s + width - 1], ' ') AS gram FROM (
    SELECT doc_id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS s
    FROM d, (SELECT DISTINCT width FROM bw) WHERE len(w) >= width)),
hit AS (SELECT * FROM dw SEMI JOIN bw USING (width, gram)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(s, s + width - 1)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items
  FROM hit JOIN bw USING (width, gram) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
