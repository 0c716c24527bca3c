"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.llm import collocations, decontaminate, embeddings, lines, lm, packing, pii, quality, simhash, suffixes, url_filter, variants, warc
from quarrylens.llm.common import table
from quarrylens.session import work_dir

TOKENIZER = "word_bpe_49k.json"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = work_dir(spark, "archives")
    warc.write_archives(pages, archives)
    found = warc.read_archives(spark, archives, payloads=False)
    kind = pages.schema["page_id"].dataType
    return found.select(
        warc.page_of("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").cast(kind).alias("refers_to"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate,
        op2_embeddings,
        op3_quality,
        op4_url_filter,
        op5_lm_scores,
        op6_line_dedup,
        op7_packing,
        op8_warc,
        op9_simhash,
        op10_suffixes,
        op11_variants,
        op12_pii,
        op13_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op6_line_dedup": lines.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
