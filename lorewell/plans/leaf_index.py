"""For each node of a graph, its best descendant leaves, level by level from below."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..operators.links import leaves as rank_leaves
from ..operators.links import resolve_links, split_links
from ..operators.ranking import leaf_scores, top_leaves
from ..sinks.files import write_intermediates


class Index(NamedTuple):
    done: DataFrame
    pending: DataFrame
    ready: DataFrame


class Parts(NamedTuple):
    """Long tables: nodes (node), edges (child, parent) distinct, own (node, leaf_id, score) of direct leaves."""

    nodes: DataFrame
    edges: DataFrame
    own: DataFrame


def parts(leaves: DataFrame, leaf_links: DataFrame, node_links: DataFrame, n: int, prune_empty_children: bool = False) -> Parts:
    """Only ids with a leaf or a child are nodes. Ids may be of any type.

    A child that is no node is waited for for ever, unless such children are pruned.
    """
    edges = cut(node_links.select("child", "parent").distinct())
    own = cut(top_leaves(leaf_scores(leaf_links, leaves).withColumnRenamed("parent", "node"), n).drop("pos"))
    nodes = cut(own.select("node").union(edges.select("parent")).distinct())
    if prune_empty_children:
        edges = cut(edges.join(nodes.select(F.col("node").alias("child")), "child", "left_semi"))
    return Parts(nodes, edges, own)


def _records(nodes: DataFrame, edges: DataFrame, ranked: DataFrame, finished: DataFrame) -> DataFrame:
    """Nested records of nodes; ranked: node, leaf_id, score, pos; finished: child ids no longer waited for."""
    tops = ranked.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "leaf_id", "score"))), lambda x: F.struct(x["leaf_id"].alias("leaf_id"), x["score"].alias("score"))).alias("top_leaves"))
    waited = edges.join(finished.select(F.col("node").alias("child")).withColumn("f", F.lit(True)), "child", "left")
    children = waited.groupBy(F.col("parent").alias("node")).agg(F.sort_array(F.collect_set("child")).alias("children"), F.sort_array(F.collect_set(F.when(F.col("f").isNull(), F.col("child")))).alias("unprocessed_children"))
    above = edges.groupBy(F.col("child").alias("node")).agg(F.sort_array(F.collect_set("parent")).alias("parents"))
    kind = dict(edges.dtypes)["parent"]
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    joined = nodes.join(tops, "node", "left").join(children, "node", "left").join(above, "node", "left")
    return joined.select(F.col("node").alias("node_id"), none("top_leaves", dict(tops.dtypes)["top_leaves"]), *(none(c, f"array<{kind}>") for c in ("children", "unprocessed_children", "parents")))


def create_nodes(leaves: DataFrame, leaf_links: DataFrame, node_links: DataFrame, n: int = 10_000) -> DataFrame:
    """Nodes with their direct leaves, children, and parents; no child is processed."""
    p = parts(leaves, leaf_links, node_links, n)
    return _records(p.nodes, p.edges, top_leaves(p.own, n), p.nodes.filter(F.lit(False)))


def split_ready(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending and ready nodes, by whether children are left to process."""
    left = F.size("unprocessed_children") > 0
    return nodes.filter(left), nodes.filter(~left)


def levels(p: Parts, iters: int, n: int) -> tuple[DataFrame, DataFrame]:
    """(node, height) up to ``iters``, and the best leaves (node, leaf_id, score, pos) of all nodes.

    Each pass promotes nodes whose children were all promoted before, and ranks only
    these; the rest is ranked once, at the end, from what has come up so far.
    """
    need = p.edges.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("need"))
    front = cut(p.nodes.join(need, "node", "left_anti").withColumn("height", F.lit(0)))
    ranked = top = cut(top_leaves(p.own.join(front, "node", "left_semi"), n))
    heights, got, come = front, None, p.own
    for k in range(iters):
        up = p.edges.join(front.select(F.col("node").alias("child")), "child").select("child", F.col("parent").alias("node"))
        fresh = up.groupBy("node").agg(F.count(F.lit(1)).alias("got"))
        got = cut(fresh if got is None else got.unionByName(fresh).groupBy("node").agg(F.sum("got").alias("got")))
        raised = up.join(top.select(F.col("node").alias("child"), "leaf_id", "score"), "child").select("node", "leaf_id", "score")
        come = cut(come.unionByName(top_leaves(raised, n).drop("pos")))
        front = cut(need.join(got, "node").filter("need = got").select("node").join(heights, "node", "left_anti").withColumn("height", F.lit(k + 1)))
        if front.limit(1).count() == 0:
            break
        top = cut(top_leaves(come.join(front.select("node"), "node", "left_semi"), n))
        heights, ranked = cut(heights.unionByName(front)), cut(ranked.unionByName(top))
    rest = top_leaves(come.join(heights, "node", "left_anti"), n)
    return heights, ranked.unionByName(rest)


def create_index(leaves: DataFrame, leaf_links: DataFrame, node_links: DataFrame, iters: int = 10, n: int = 10_000, prune_empty_children: bool = False) -> Index:
    """Nodes done (all children done), pending (some never are, as on a cycle) and ready (done with the last pass)."""
    p = parts(leaves, leaf_links, node_links, n, prune_empty_children)
    heights, ranked = levels(p, iters, n)
    records = cut(_records(p.nodes, p.edges, ranked, heights.filter(F.col("height") < iters)).join(heights.withColumnRenamed("node", "node_id"), "node_id", "left"))
    done = records.filter(F.col("height") < iters).drop("height")
    return Index(done, records.filter("height is null").drop("height"), records.filter(F.col("height") == iters).drop("height"))


def create_category_index(links: DataFrame, pages: DataFrame, entities: DataFrame, ranks: DataFrame, iters: int = 10, n: int = 10_000, prune_empty_children: bool = False, intermediates: str | None = None) -> Index:
    """The index of categories, from dumps. intermediates: a folder for the links between nodes and of leaves."""
    node_links, leaf_links = split_links(cut(resolve_links(links, pages, entities)))
    if intermediates:
        write_intermediates(intermediates, node_links=node_links, leaf_links=leaf_links)
    return create_index(rank_leaves(ranks), leaf_links, node_links, iters, n, prune_empty_children)
