"""Batch document search: chunks, keyword and vector ranking, rank fusion, access filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions.numeric import ratio, rnd
from quarrylens.operators.keyword_index import UNIT, KeywordIndex
from quarrylens.operators.rights import RightsIndex
from quarrylens.operators.vector_index import VectorIndex

WORDS = r"[^\p{L}\p{N}]+"


def sections(docs: DataFrame, heading: str = r"(?m)^(?=#{1,6} )", id_col: str = "doc_id") -> DataFrame:
    """One row per headed section (the whole text when there is no heading)."""
    return docs.select(id_col, F.posexplode(F.split("text", heading)).alias("section", "text")).filter(F.length("text") > 0)


def chunk(docs: DataFrame, size: int = 800, overlap: int = 100, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Overlapping windows of ``size`` characters covering the whole text, generated row by row."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - overlap - 1, F.lit(0)), F.lit(step))
    return docs.select(id_col, *keep, "text", F.posexplode(starts).alias("chunk_no", "start")).select(
        id_col, *keep, "chunk_no", "start", F.substring(F.col("text"), F.col("start") + 1, F.lit(size)).alias("text")
    )


def tokens(c: str | Column) -> Column:
    """Lower-case words of letters and digits."""
    text = F.col(c) if isinstance(c, str) else c
    return F.array_remove(F.split(F.lower(text), WORDS), "")


def keyword_topk(chunks: DataFrame, queries: DataFrame, k: int, key: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 over chunks; ``queries`` is (query_id, term), one row per distinct keyword.

    Builds an index of the asked terms only.  To search the same chunks again, build a
    :class:`KeywordIndex` without ``only`` and keep it.
    """
    index = KeywordIndex.build(chunks, key, tokens("text"), k1, b, only=queries)
    return keyword_search(index, queries, k)


def keyword_search(index: KeywordIndex, queries: DataFrame, k: int) -> DataFrame:
    """Best ``k`` chunks per query by BM25, rounded to four places; ties go to the smaller key."""
    score = rnd(F.col("score") / UNIT, 4).alias("score")
    return top_per_query(index.search(queries, k).select("query_id", *index.key, score), k, index.key)


def top_per_query(scored: DataFrame, k: int, key: list[str]) -> DataFrame:
    """Best ``k`` per query; a WindowGroupLimit keeps k rows per query in every map task."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), *key)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest_in_group(emb: DataFrame, centres: DataFrame, group: str, k: int, id_col: str = "vec_id") -> DataFrame:
    """Best ``k`` vectors of each group against the group's own centre: an equi-join, no pairing across groups."""
    scored = emb.join(centres, group).select(
        F.col(group).alias("query_id"), id_col, rnd(cosine(F.col("embedding"), F.col("centre")), 6).alias("score")
    )
    return top_per_query(scored, k, [id_col])


def centres_of(emb: DataFrame, group: str) -> DataFrame:
    """Mean vector per group from exact per-dimension sums (keyed by group and dimension)."""
    dims = emb.select(group, F.posexplode("embedding").alias("pos", "x"))
    means = dims.groupBy(group, "pos").agg(ratio(F.sum(F.col("x").cast("decimal(18,9)")), F.count("x")).alias("m"))
    # One short list per group: as many entries as the vector has dimensions.
    return means.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("_l")).select(
        group, F.col("_l.m").alias("centre")
    )


def vector_topk(emb: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", block: int = 512) -> DataFrame:
    """Exact cosine top-k of (query_id, centre) over every vector, rounded to six places; ties go to the smaller id.

    Queries stay rows, ``block`` of them in one matrix product.  To search the same vectors again, keep
    a :class:`VectorIndex`.
    """
    return top_per_query(VectorIndex.build(emb, id_col).search(queries, k, block), k, [id_col])


def fuse_ranks(a: DataFrame, b: DataFrame, k: int, key: list[str], constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists."""
    left = a.select("query_id", *key, F.col("rank").alias("_ra"))
    right = b.select("query_id", *key, F.col("rank").alias("_rb"))
    part = lambda c: F.coalesce(F.lit(1.0) / (F.lit(constant) + F.col(c)), F.lit(0.0))
    both = left.join(right, ["query_id", *key], "full").select("query_id", *key, rnd(part("_ra") + part("_rb"), 8).alias("score"))
    return top_per_query(both, k, key)


def allowed(docs: DataFrame, acl: DataFrame, principal: str, memberships: DataFrame, on: str) -> DataFrame:
    """Documents whose ``on`` value is granted to one of the principal's groups.

    ``acl`` is (group_name, <on>); the filter runs before anything is scored.
    """
    mine = memberships.filter(F.col("principal") == principal).select("group_name").distinct()
    granted = acl.join(mine, "group_name", "left_semi").select(on).distinct()
    return docs.join(granted, on, "left_semi")


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    filters: Column | None = None,
    acl: DataFrame | None = None,
    memberships: DataFrame | None = None,
    principal: str | None = None,
    on: str = "source",
    rights: RightsIndex | None = None,
) -> DataFrame:
    """Keyword search over chunks of the documents that pass the filters and the caller's grants.

    With ``rights`` the grants are tested by bitmaps, without it by a semi join on ``on``.
    """
    rows = docs if filters is None else docs.filter(filters)
    if principal is not None and rights is not None:
        rows = rights.restrict(rows, principal, memberships, acl)
    elif principal is not None:
        rows = allowed(rows, acl, principal, memberships, on)
    return keyword_topk(chunk(rows), queries, k, ["doc_id", "chunk_no"])
