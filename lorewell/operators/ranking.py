"""Top-k and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import INSTANCE_OF, SUBCLASS_OF


def leaf_scores(leaf_links: DataFrame, leaves: DataFrame) -> DataFrame:
    """Each distinct link with its leaf's score: the largest if there are several, 0 if there is none."""
    best = leaves.groupBy("leaf_id").agg(F.max("score").alias("score"))
    return leaf_links.select("leaf_id", "parent").distinct().join(best, "leaf_id", "left").select("parent", "leaf_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """How many keys occur more than once, and in how many rows: keys, rows. What is merged by ``leaf_scores`` or as nodes."""
    several = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return several.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def top_leaves(rows: DataFrame, n: int) -> DataFrame:
    """The n best distinct leaves of each node (node, leaf_id, score), with ``pos`` from 1; ties to the smaller leaf.

    Spark keeps n rows of a node in each task before it shuffles, so a node with very many leaves is no burden.
    """
    order = Window.partitionBy("node").orderBy(F.col("score").desc(), F.col("leaf_id").asc())
    distinct = rows.groupBy("node", "leaf_id").agg(F.max("score").alias("score"))
    return distinct.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= n)


def parents(entities: DataFrame) -> DataFrame:
    """All instance-of, then all subclass-of parents of each entity, repeats kept."""
    get = lambda p: F.coalesce(F.element_at("claims", F.lit(p)), F.array().cast("array<bigint>"))
    return entities.select(F.explode(F.concat(get(INSTANCE_OF), get(SUBCLASS_OF))).alias("parent"))


def top_parents(entities: DataFrame, n: int = 1000) -> DataFrame:
    """The n most frequent parents: count, parent; ties to the larger parent."""
    counts = parents(entities).groupBy("parent").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("count", "parent").orderBy(F.col("count").desc(), F.col("parent").desc()).limit(n)
