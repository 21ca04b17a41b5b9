"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, html_extract, language_model, mixing, near_dedup, packing, quality_rules, top_k, toxicity, url_filters
from .common import table


def vocabulary() -> str:
    """The path of the public byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.rule_table(spark, URL_RULES)
    return url_filters.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), 2048)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat_format.probe(spark), allowMissingColumns=True)
    return chat_format.digests(chat_format.format_conversations(rows))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), SOURCE_PARTS).select("doc_id", "source", "block", "slot", "place")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return language_model.quality_model(table(spark, sf_dir, "documents"), trusted)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


#: The contract's rules: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Target weights of sources, in parts; other sources have one part each.
SOURCE_PARTS = {"src0": 10}

QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_url_filters": op2_url_filters,
    "op3_packing": op3_packing,
    "op4_chat_format": op4_chat_format,
    "op5_html_extraction": op5_html_extraction,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_dedup": op10_near_dedup,
}

ORACLE_SQL = {
    "op1_top_k": top_k.top_k_sql(),
    "op2_url_filters": url_filters.url_filter_sql(URL_RULES),
    "op4_chat_format": chat_format.chat_format_sql(),
    "op10_near_dedup": near_dedup.near_dedup_sql(),
}
