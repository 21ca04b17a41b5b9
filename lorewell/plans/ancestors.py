"""All ancestors with the shortest depth, by doubling of paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..schemas import INSTANCE_OF, SUBCLASS_OF

#: A depth as one number: hops, then instance hops, so that the smaller number is the smaller depth.
_HOP = 1 << 32


def direct(nodes: DataFrame) -> DataFrame:
    """(node, ancestor, cost) of nodes (node_id, instance_of, subclass_of); subclass wins over instance."""
    up = lambda c, cost: nodes.select(F.col("node_id").alias("node"), F.explode(c).alias("ancestor"), F.lit(cost).cast("long").alias("cost"))
    return up("instance_of", _HOP + 1).unionByName(up("subclass_of", _HOP)).groupBy("node", "ancestor").agg(F.min("cost").alias("cost"))


def entity_nodes(entities: DataFrame) -> DataFrame:
    claim = lambda p: F.coalesce(F.element_at("claims", F.lit(p)), F.array().cast("array<bigint>"))
    return entities.select(F.col("qid").alias("node_id"), claim(INSTANCE_OF).alias("instance_of"), claim(SUBCLASS_OF).alias("subclass_of"))


def closure(steps: DataFrame, iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """Least costs (node, ancestor, cost) over walks of up to 2**iterations hops, and the frontier left (node, ancestor).

    A pass joins the frontier with all ancestors known before it. Candidates of
    twice the pass's depth or more are the next frontier, improving or not.
    """
    known = cut(steps)
    front = known
    for k in range(iterations):
        # The frontier is spread by the node in the middle; AQE splits popular ones.
        ahead = known.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("far"), F.col("cost").alias("more"))
        found = cut(front.join(ahead, "ancestor").groupBy("node", F.col("far").alias("ancestor")).agg(F.min(F.col("cost") + F.col("more")).alias("cost"), F.max(F.col("cost") + F.col("more")).alias("farthest")))
        known = cut(known.unionByName(found.drop("farthest")).groupBy("node", "ancestor").agg(F.min("cost").alias("cost")))
        front = cut(found.filter(F.col("farthest") >= (2 << k) * _HOP).select("node", "ancestor").join(known, ["node", "ancestor"]))
        if front.limit(1).count() == 0:
            break
    return known, front.select("node", "ancestor")


def depths(known: DataFrame) -> DataFrame:
    """node, ancestor, instances, subclasses."""
    instances = F.col("cost") % _HOP
    return known.select("node", "ancestor", instances.cast("int").alias("instances"), (F.floor(F.col("cost") / _HOP) - instances).cast("int").alias("subclasses"))


def gather_ancestors(nodes: DataFrame, iterations: int = 10) -> DataFrame:
    """Nodes (node_id, instance_of, subclass_of) -> node_id, ancestors (map to depths), unprocessed_ancestors.

    Ancestors that are no nodes themselves are kept, not followed. A node on a cycle is its own ancestor.
    """
    known, front = closure(direct(nodes), iterations)
    entry = F.struct("ancestor", F.struct("instances", "subclasses"))
    maps = depths(known).groupBy(F.col("node").alias("node_id")).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("ancestors"))
    open_ = front.groupBy(F.col("node").alias("node_id")).agg(F.sort_array(F.collect_set("ancestor")).alias("unprocessed_ancestors"))
    kind = dict(known.dtypes)["ancestor"]
    joined = nodes.select("node_id").distinct().join(maps, "node_id", "left").join(open_, "node_id", "left")
    return joined.select(
        "node_id",
        F.coalesce("ancestors", F.create_map().cast(f"map<{kind},struct<instances:int,subclasses:int>>")).alias("ancestors"),
        F.coalesce("unprocessed_ancestors", F.array().cast(f"array<{kind}>")).alias("unprocessed_ancestors"),
    )


def gather_entity_ancestors(entities: DataFrame, iterations: int = 10) -> DataFrame:
    return gather_ancestors(entity_nodes(entities), iterations)
