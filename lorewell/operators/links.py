"""Joins that turn category links into edges between entities, with their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORY_NAMESPACE, CATEGORY_PREFIX


def rekey(values: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Give values the second keys that share their first: an inner join, bags stay bags. Skew is left to AQE."""
    return values.join(keys, on).drop(*on)


def group_sizes(values: DataFrame, keys: DataFrame, on: list[str], names: tuple[str, str] = ("v_per_key", "keys_per_key")) -> DataFrame:
    """How many rows the sides of ``rekey`` have for each key of either: metric, keys, total, least, most, mean."""
    left = values.groupBy(*on).agg(F.count(F.lit(1)).alias("a"))
    right = keys.groupBy(*on).agg(F.count(F.lit(1)).alias("b"))
    both = left.join(right, on, "full").select(F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    measure = lambda c, name: both.agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(c), F.lit(0)).alias("total"), F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"))
    return measure("a", names[0]).unionByName(measure("b", names[1]))


def titles(entities: DataFrame) -> DataFrame:
    """title, is_cat, qid of entities that have a title; a category's prefix is taken off."""
    category = F.startswith("title", F.lit(CATEGORY_PREFIX))
    name: Column = F.when(category, F.substr("title", F.lit(len(CATEGORY_PREFIX) + 1))).otherwise(F.col("title"))
    return entities.filter("title is not null and title <> ''").select(name.alias("title"), category.alias("is_cat"), "qid")


def title_counts(entities: DataFrame) -> DataFrame:
    """Counters of the titles read: categories and non_categories."""
    return titles(entities).agg(F.count_if("is_cat").alias("categories"), F.count_if(~F.col("is_cat")).alias("non_categories"))


def resolve_links(links: DataFrame, pages: DataFrame, entities: DataFrame) -> DataFrame:
    """Category links by entity: parent, child, child_is_cat.

    Page to entity by title and kind, then link to child by page, then parent by
    category title. Whether a child is a category comes from its entity's title.
    """
    named = titles(entities)
    page_ids = pages.select("title", (F.col("namespace") == CATEGORY_NAMESPACE).alias("is_cat"), "page_id")
    children = rekey(named.select("title", "is_cat", F.col("qid").alias("child"), F.col("is_cat").alias("child_is_cat")), page_ids, ["title", "is_cat"])
    categories = links.select("page_id", F.col("category").alias("title"))
    by_title = rekey(children, categories, ["page_id"])
    parents = named.filter("is_cat").select("title", F.col("qid").alias("parent"))
    return rekey(by_title, parents, ["title"]).select("parent", "child", "child_is_cat")


def link_metrics(links: DataFrame, pages: DataFrame, entities: DataFrame) -> dict[str, DataFrame]:
    """``title_counts``, and ``group_sizes`` of the three joins of ``resolve_links``."""
    named = titles(entities)
    page_ids = pages.select("title", (F.col("namespace") == CATEGORY_NAMESPACE).alias("is_cat"), "page_id")
    categories = links.select("page_id", F.col("category").alias("title"))
    by_page = rekey(named, page_ids, ["title", "is_cat"])
    return {
        "titles": title_counts(entities),
        "title_to_page": group_sizes(named, page_ids, ["title", "is_cat"]),
        "page_to_category": group_sizes(by_page, categories, ["page_id"]),
        "category_to_parent": group_sizes(rekey(by_page.select("page_id"), categories, ["page_id"]), named.filter("is_cat").select("title"), ["title"]),
    }


def page_categories(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Each page with the sorted titles of its categories: page_id, categories. A page's links are few."""
    listed = links.groupBy("page_id").agg(F.sort_array(F.collect_list("category")).alias("categories"))
    return pages.select("page_id").join(listed, "page_id", "left").select("page_id", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"))


def split_links(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges between categories (child, parent), and links of leaves (leaf_id, parent)."""
    nodes = resolved.filter("child_is_cat").select("child", "parent")
    return nodes, resolved.filter("not child_is_cat").select(F.col("child").alias("leaf_id"), "parent")


def leaves(ranks: DataFrame) -> DataFrame:
    return ranks.select(F.col("qid").alias("leaf_id"), F.col("qrank").cast("double").alias("score"))
