"""Line deduplication by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import sent_whole, stored

# A line on more than this share of a host's pages, and on at least so many of them, is boilerplate.
RATIO = 0.01
MIN_PAGES = 4
SALTS = 16


def _keys(text: Column) -> Column:
    """One digest per line.  Lines without visible characters have a null key and are never dropped."""
    return F.transform(F.split(text, "\n"), lambda line: F.when(F.trim(line) != "", F.md5(F.trim(line).cast("binary"))))


def boilerplate(lines: DataFrame, pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """``host, key`` of the lines to drop; ``lines`` has one row per (page, distinct line)."""
    counts = lines.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    joined = counts.join(totals, counts["host"].eqNullSafe(totals["host"]))
    return joined.where(F.col("n") > ratio * F.col("total")).select(counts["host"], "key")


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    salts: int = SALTS,
) -> DataFrame:
    """All rows and columns of ``docs``, texts without the boilerplate lines of their host.

    A line counts once per page, compared without surrounding blanks, and is dropped wherever it
    stands when its share of the host's pages exceeds ``ratio`` and at least ``min_pages`` pages
    have it (on a small host one page may be a large share).  Adds ``n_lines`` and ``n_dropped``
    (overwriting columns of these names).  A null text stays null with 0 lines; a null host is a
    host of its own.  Rows that repeat an id (and null ids) are pages of their own in the counts,
    and lose the lines that any of them loses on its host.  A text made of boilerplate only
    becomes empty; an empty table stays empty.

    Counts are added up in the map tasks; the lines of a hot host are dealt out by line, and a
    line on many pages is joined in ``salts`` parts, unless the dropped lines are sent to all tasks.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.array_compact(F.array_distinct(_keys(F.col(text_col)))).alias("keys")
    )
    lines = rows.select("id", "host", F.explode("keys").alias("key"))
    drops = stored(boilerplate(lines, docs.select(F.col(host_col).alias("host")), ratio, min_pages), "lines-drops")
    drops = drops.select(F.col("host").alias("drop_host"), F.col("key").alias("drop_key"))
    same = (F.col("key") == F.col("drop_key")) & F.col("host").eqNullSafe(F.col("drop_host"))
    if sent_whole(drops):
        hits = lines.join(drops, same, "left_semi")
    else:
        # The planner takes the parts for one, by the size of the stored drops: it may not send them.
        parts = drops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        salted = lines.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        hits = salted.join(parts, same & (F.col("at") == F.col("salt")), "left_semi")
    marks = hits.groupBy("id", "host").agg(F.collect_set("key").alias("keys_gone"))
    marks = marks.select(F.col("id").alias("mark_id"), F.col("host").alias("mark_host"), "keys_gone")

    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    pages = docs.select(*names)
    joined = pages.join(
        marks, pages[id_col].eqNullSafe(marks["mark_id"]) & pages[host_col].eqNullSafe(marks["mark_host"]), "left"
    )
    gone, before = marks["keys_gone"], pages[text_col]
    split = F.split(before, "\n")
    kept = F.filter(
        split,
        lambda line: ~F.coalesce(F.array_contains(gone, F.md5(F.trim(line).cast("binary"))), F.lit(False)),
    )
    touched = gone.isNotNull()
    text = F.when(touched, F.array_join(kept, "\n")).otherwise(before)
    n_lines = F.coalesce(F.size(split), F.lit(0))
    n_lines = F.when(before.isNull(), 0).otherwise(n_lines)
    n_kept = F.when(touched, F.size(kept)).otherwise(n_lines)
    return joined.select(
        *[text.alias(c) if c == text_col else pages[c] for c in names],
        n_lines.cast("bigint").alias("n_lines"),
        (n_lines - n_kept).cast("bigint").alias("n_dropped"),
    )


def without_boilerplate(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with shortened texts; ``n_chars`` follows the text."""
    out = drop_boilerplate(docs).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.coalesce(F.length("text"), F.lit(0)).cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(changed))
    return out.select(*docs.columns)


ORACLE = f"""
WITH l AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
e AS (SELECT DISTINCT doc_id, source, trim(line) AS line FROM (SELECT doc_id, source, unnest(lines) AS line FROM l)
  WHERE trim(line) <> ''),
t AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
g AS (SELECT source, line FROM (SELECT source, line, count(*) AS n FROM e GROUP BY source, line)
  JOIN t USING (source) WHERE n >= {MIN_PAGES} AND n > {RATIO} * total),
p AS (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l),
k AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.i) FILTER (WHERE g.line IS NULL) AS text,
  count(*) AS n_lines, count(g.line) AS n_dropped
  FROM p LEFT JOIN g ON g.source = p.source AND g.line = trim(p.line) GROUP BY p.doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_dropped FROM k
"""
