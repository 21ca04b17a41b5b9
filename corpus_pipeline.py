"""From raw documents to packed sequences, in five stages.

Quality rules and the quality classifier drop what they reject, near-dedup
leaves one document of each group, mixing gives the rest the slots that its
schedule gives the sources, and packing makes sequences of ranges of slots, numbered in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorewell.llm import language_model, mixing, near_dedup, packing, quality_rules, registry
from lorewell.llm.common import checkpointed, forget, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_rules(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return language_model.keep_fluent(docs, trusted)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, registry.SOURCE_PARTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, registry.vocabulary(), packing.SEQUENCE, mixed="slot" in docs.columns)


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("near-dedup", dedup), ("mixing", mixed), ("packing", packed)]

#: Compression, perplexities and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is a table in the shared folder until the next stage is done."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
        forget(*before)
        before = [docs]
    out = STAGES[-1][1](spark, docs, sf_dir)
    forget(*before)  # packing has read its documents when it returns
    return out
