"""The registered queries over the supplied tables, with their SQL for DuckDB.

Each query puts tables into the shape that an operator takes, applies it, and
flattens nested results, so both engines return plain rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import links, ranking
from ..schemas import CATEGORY_PREFIX, INSTANCE_OF, SUBCLASS_OF
from ..sinks import files
from ..sources import records
from . import ancestors, leaf_index

#: Ids of nations and regions among entities and pages, and of the root.
NATION, REGION, ROOT = 1 << 40, 1 << 41, 1 << 42


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ------------------------------------------------------------- counts and joins


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """Line items as entities: instance of their supplier, subclass of their part."""
    array = lambda c: F.array(F.col(c).cast("long"))
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("qid"), F.create_map(F.lit(INSTANCE_OF), array("l_suppkey"), F.lit(SUBCLASS_OF), array("l_partkey")).alias("claims"))


def count_children_topn(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_parents(_claims(spark, d), 100)


def rekey_join(spark: SparkSession, d: str) -> DataFrame:
    values = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))
    keys = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("k2"))
    return links.rekey(values, keys, ["k"])


def metrics_distribution(spark: SparkSession, d: str) -> DataFrame:
    values = _t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    keys = _t(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return links.group_sizes(values, keys, ["k"])


def _world(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as leaves of their nations, nations of their regions: links, pages, entities."""
    c, n, r = (_t(spark, d, t) for t in ("customer", "nation", "region"))
    names = (
        c.select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("title"), F.lit(False).alias("cat"))
        .unionByName(n.select((F.col("n_nationkey") + F.lit(NATION)).alias("id"), F.col("n_name").alias("title"), F.lit(True).alias("cat")))
        .unionByName(r.select((F.col("r_regionkey") + F.lit(REGION)).alias("id"), F.col("r_name").alias("title"), F.lit(True).alias("cat")))
    )
    pages = names.select(F.col("id").alias("page_id"), "title", F.when(F.col("cat"), 14).otherwise(0).alias("namespace"))
    entities = names.select(F.col("id").alias("qid"), F.concat(F.when(F.col("cat"), CATEGORY_PREFIX).otherwise(""), "title").alias("title"))
    up = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").cast("long").alias("page_id"), F.col("n_name").alias("category"))
    up = up.unionByName(n.join(r, n.n_regionkey == r.r_regionkey).select((F.col("n_nationkey") + F.lit(NATION)).alias("page_id"), F.col("r_name").alias("category")))
    return up, pages, entities


def resolve_links(spark: SparkSession, d: str) -> DataFrame:
    return links.resolve_links(*_world(spark, d))


def title_counts(spark: SparkSession, d: str) -> DataFrame:
    return links.title_counts(_world(spark, d)[2])


def split_links(spark: SparkSession, d: str) -> DataFrame:
    nodes, leaf = links.split_links(resolve_links(spark, d))
    return nodes.select(F.lit("node").alias("kind"), "child", "parent").union(leaf.select(F.lit("leaf"), "leaf_id", "parent"))


def leaf_scores(spark: SparkSession, d: str) -> DataFrame:
    leaf_links = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("leaf_id"), F.col("l_suppkey").alias("parent"))
    scores = _t(spark, d, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("leaf_id"), F.col("p_retailprice").alias("score"))
    return ranking.leaf_scores(leaf_links, scores)


# ---------------------------------------------------------------- the leaf index


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, scored by their dearest order, below nations, regions and one root; ids are texts."""
    o, c, n, r = (_t(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    leaves = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("score")).select(F.concat(F.lit("C"), "o_custkey").alias("leaf_id"), "score")
    leaf_links = c.select(F.concat(F.lit("C"), "c_custkey").alias("leaf_id"), F.concat(F.lit("N"), "c_nationkey").alias("parent"))
    up = n.select(F.concat(F.lit("N"), "n_nationkey").alias("child"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    return leaves, leaf_links, up.unionByName(r.select(F.concat(F.lit("R"), "r_regionkey").alias("child"), F.lit("ROOT").alias("parent")))


def _tops(nodes: DataFrame) -> DataFrame:
    return nodes.select("node_id", F.posexplode("top_leaves").alias("p", "leaf")).select("node_id", (F.col("p") + 1).alias("pos"), "leaf.leaf_id", "leaf.score")


def top_leaves_per_node(spark: SparkSession, d: str) -> DataFrame:
    leaves, leaf_links, _ = _graph(spark, d)
    rows = ranking.leaf_scores(leaf_links, leaves).withColumnRenamed("parent", "node")
    return ranking.top_leaves(rows, 5).select(F.col("node").alias("node_id"), "pos", "leaf_id", "score")


def node_build(spark: SparkSession, d: str) -> DataFrame:
    nodes = leaf_index.create_nodes(*_graph(spark, d), n=3)
    part = lambda kind, c: nodes.select("node_id", F.lit(kind).alias("kind"), F.explode(c).alias("member"))
    tops = nodes.select("node_id", F.lit("leaf").alias("kind"), F.explode("top_leaves.leaf_id").alias("member"))
    return part("child", "children").unionByName(part("parent", "parents")).unionByName(part("waits", "unprocessed_children")).unionByName(tops)


def split_ready_pending(spark: SparkSession, d: str) -> DataFrame:
    pending, ready = leaf_index.split_ready(leaf_index.create_nodes(*_graph(spark, d), n=3))
    return pending.select("node_id", F.lit("pending").alias("state")).unionByName(ready.select("node_id", F.lit("ready").alias("state")))


def category_index_done(spark: SparkSession, d: str) -> DataFrame:
    return _tops(leaf_index.create_index(*_graph(spark, d), n=20).done)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return category_index_done(spark, d)


def category_index_cyclic(spark: SparkSession, d: str) -> DataFrame:
    """With R0 below N3 as well, some nodes never are ready."""
    leaves, leaf_links, up = _graph(spark, d)
    back = spark.range(1).select(F.lit("R0").alias("child"), F.lit("N3").alias("parent"))
    index = leaf_index.create_index(leaves, leaf_links, up.unionByName(back), n=7)
    state = lambda nodes, name: nodes.select("node_id", F.lit(name).alias("state"), "top_leaves")
    every = state(index.done, "done").unionByName(state(index.pending, "pending")).unionByName(state(index.ready, "ready"))
    return every.select("node_id", "state", F.posexplode_outer("top_leaves").alias("p", "leaf")).select("node_id", "state", F.coalesce(F.col("p") + 1, F.lit(0)).alias("pos"), "leaf.leaf_id", "leaf.score")


def category_index_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """Two passes only: regions are ready, the root is pending. Leaves and children waited for, by node."""
    index = leaf_index.create_index(*_graph(spark, d), iters=1, n=4)
    state = lambda nodes, name: nodes.withColumn("state", F.lit(name))
    every = state(index.done, "done").unionByName(state(index.pending, "pending")).unionByName(state(index.ready, "ready"))
    part = lambda kind, c: every.select("node_id", "state", F.lit(kind).alias("kind"), F.posexplode(c).alias("pos", "member"))
    return part("leaf", "top_leaves.leaf_id").unionByName(part("waits", "unprocessed_children")).unionByName(every.select("node_id", "state", F.lit("node").alias("kind"), F.lit(0).alias("pos"), F.lit("").alias("member")))


def category_index_from_links(spark: SparkSession, d: str) -> DataFrame:
    """All the way from links, pages, entities and ranks."""
    ranks = _t(spark, d, "orders").groupBy(F.col("o_custkey").cast("long").alias("qid")).agg(F.floor(F.max("o_totalprice")).alias("qrank"))
    return _tops(leaf_index.create_category_index(*_world(spark, d), ranks, n=10).done)


# ------------------------------------------------------------------- ancestors


def _chain(spark: SparkSession, d: str) -> DataFrame:
    """Customers below half their number (subclass); suppliers below their nation, that below its region (instance)."""
    c, s, n = (_t(spark, d, t) for t in ("customer", "supplier", "nation"))
    one = lambda x: F.array(x.cast("long"))
    none = F.array().cast("array<bigint>")
    tree = c.select(F.col("c_custkey").cast("long").alias("node_id"), none.alias("instance_of"), F.when(F.col("c_custkey") > 1, one(F.floor(F.col("c_custkey") / 2))).otherwise(none).alias("subclass_of"))
    up = s.select((F.col("s_suppkey") + F.lit(ROOT)).alias("node_id"), one(F.col("s_nationkey") + F.lit(NATION)).alias("instance_of"), F.array((F.col("s_suppkey") % 7 + 1).cast("long")).alias("subclass_of"))
    return tree.unionByName(up).unionByName(n.select((F.col("n_nationkey") + F.lit(NATION)).alias("node_id"), one(F.col("n_regionkey") + F.lit(REGION)).alias("instance_of"), none.alias("subclass_of")))


def _flat(gathered: DataFrame) -> DataFrame:
    return gathered.select(F.col("node_id").alias("node"), F.explode("ancestors").alias("ancestor", "depth")).select("node", "ancestor", "depth.instances", "depth.subclasses")


def ancestors_min_depth(spark: SparkSession, d: str) -> DataFrame:
    return _flat(ancestors.gather_ancestors(_chain(spark, d)))


def ancestors_cyclic(spark: SparkSession, d: str) -> DataFrame:
    k, up = F.col("n_nationkey").cast("long"), F.array(((F.col("n_nationkey") * 7 + 3) % 25).cast("long"))
    none = F.array().cast("array<bigint>")
    return _flat(ancestors.gather_ancestors(_t(spark, d, "nation").select(k.alias("node_id"), F.when(k % 3 == 0, up).otherwise(none).alias("instance_of"), F.when(k % 3 != 0, up).otherwise(none).alias("subclass_of"))))


def ancestors_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """Two passes reach four hops; what may go on is left as the frontier."""
    g = ancestors.gather_ancestors(_chain(spark, d), iterations=2)
    flat = g.select(F.col("node_id").alias("node"), F.explode("ancestors").alias("ancestor", "depth"), F.col("unprocessed_ancestors").alias("open"))
    return flat.select("node", "ancestor", "depth.instances", "depth.subclasses", F.array_contains("open", F.col("ancestor")).alias("frontier"))


def entity_ancestors(spark: SparkSession, d: str) -> DataFrame:
    """From entities with claims: suppliers are instances of nations, nations subclasses of regions, which claim nothing."""
    s, n, r = (_t(spark, d, t) for t in ("supplier", "nation", "region"))
    one = lambda p, c: F.create_map(F.lit(p), F.array(c.cast("long")))
    rows = (
        s.select((F.col("s_suppkey") + F.lit(ROOT)).alias("qid"), one(INSTANCE_OF, F.col("s_nationkey") + F.lit(NATION)).alias("claims"))
        .unionByName(n.select((F.col("n_nationkey") + F.lit(NATION)).alias("qid"), one(SUBCLASS_OF, F.col("n_regionkey") + F.lit(REGION)).alias("claims")))
        .unionByName(r.select((F.col("r_regionkey") + F.lit(REGION)).alias("qid"), F.create_map().cast("map<int,array<bigint>>").alias("claims")))
    )
    gathered = ancestors.gather_entity_ancestors(rows)
    return gathered.select(F.col("node_id").alias("node"), F.explode_outer("ancestors").alias("ancestor", "depth")).select("node", "ancestor", "depth.instances", "depth.subclasses")


# ---------------------------------------------------------------- readers, sinks


def _insert(rows: DataFrame, table: str, fields: list) -> DataFrame:
    """Rows as INSERT lines of a dump, some hundred a line."""
    tuples = rows.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("t"), (F.xxhash64(*rows.columns) % 16).alias("g"))
    return tuples.groupBy("g").agg(F.concat_ws(",", F.collect_list("t")).alias("v")).select(F.concat(F.lit(f"INSERT INTO `{table}` VALUES "), "v", F.lit(";")).alias("value"))


def _quoted(c):
    return F.concat(F.lit("'"), c, F.lit("'"))


def dump_roundtrip_page(spark: SparkSession, d: str) -> DataFrame:
    text = lambda x: F.lit(x)
    rows = _t(spark, d, "customer")
    fields = [F.col("c_custkey").cast("string"), (F.col("c_nationkey") % 3 * 7).cast("string"), _quoted("c_name"), (F.col("c_custkey") % 5 == 0).cast("int").cast("string"), text("0"), text("0.123"), text("'20220701'"), text("NULL"), F.col("c_custkey").cast("string"), text("17"), text("'wikitext'"), text("NULL")]
    return records.pages(_insert(rows, "page", fields))


def dump_roundtrip_categorylinks(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "customer")
    kinds = F.when(F.col("c_custkey") % 4 == 0, "file").when(F.col("c_custkey") % 4 == 1, "subcat").otherwise("page")
    fields = [F.col("c_custkey").cast("string"), _quoted("c_mktsegment"), F.lit("'a\\r,(b'"), F.lit("'2022-07-01 00:00:00'"), F.lit("''"), F.lit("'uca'"), _quoted(kinds)]
    return records.category_links(_insert(rows, "categorylinks", fields))


def json_claims(spark: SparkSession, d: str) -> DataFrame:
    """Orders as entities of a JSON dump; every second supplier's claim is deprecated, texts of parts are no items."""
    item = lambda c, rank: F.struct(F.lit(rank).alias("rank"), F.struct(F.lit("value").alias("snaktype"), F.lit("wikibase-item").alias("datatype"), F.struct(F.lit("wikibase-entityid").alias("type"), F.struct(F.lit("item").alias("entity-type"), F.concat(F.lit("Q"), c).alias("id")).alias("value")).alias("datavalue")).alias("mainsnak"))
    supplier = F.when(F.col("l_suppkey") % 2 == 0, item(F.col("l_suppkey"), "deprecated")).otherwise(item(F.col("l_suppkey"), "normal"))
    claims = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.struct(F.sort_array(F.collect_list(supplier)).alias("P31"), F.sort_array(F.collect_list(item(F.col("l_partkey"), "normal"))).alias("P279"), F.sort_array(F.collect_list(item(F.col("l_partkey"), "normal"))).alias("P5")).alias("claims"))
    named = F.struct(F.struct(F.concat(F.lit("Order "), F.col("o_orderkey")).alias("title")).alias("enwiki"), F.struct(F.lit("x").alias("title")).alias("dewiki"))
    rows = _t(spark, d, "orders").join(claims, F.col("o_orderkey") == F.col("l_orderkey"))
    entity = F.struct(F.concat(F.lit("Q"), "o_orderkey").alias("id"), F.struct(F.struct(F.col("o_orderpriority").alias("value")).alias("en")).alias("labels"), named.alias("sitelinks"), "claims")
    lines = rows.select(F.concat(F.to_json(entity), F.lit(",")).alias("value")).union(spark.createDataFrame([("[",), ("]",), ('{"id": Q9}',)], "value string"))
    found = records.entities(lines, require_title=True)
    return found.select("qid", "title", "label", "sitelinks", F.explode("claims").alias("pid", "items")).select("qid", "title", "label", "sitelinks", "pid", F.explode("items").alias("item"))


def json_claim_cases(spark: SparkSession, d: str) -> DataFrame:
    """Orders as entities whose claims fail in one way each, by key: only those without a rank, or a common one, count."""
    k = F.col("o_orderkey") % 11
    rank = F.when(k == 0, F.lit(None)).when(k == 1, F.lit("deprecated")).otherwise(F.lit("preferred")).cast("string")
    snak = F.struct(
        F.when(k == 2, F.lit("novalue")).otherwise(F.lit("value")).alias("snaktype"),
        F.when(k == 3, F.lit("string")).otherwise(F.lit("wikibase-item")).alias("datatype"),
        F.when(
            k != 4,
            F.struct(
                F.when(k == 5, F.lit("string")).otherwise(F.lit("wikibase-entityid")).alias("type"),
                F.when(k != 6, F.struct(F.when(k == 7, F.lit("property")).otherwise(F.lit("item")).alias("entity-type"), F.when(k != 8, F.concat(F.lit("Q"), "o_custkey")).alias("id"))).alias("value"),
            ),
        ).alias("datavalue"),
    )
    claims = F.when(k != 9, F.struct(F.array(F.struct(rank.alias("rank"), snak.alias("mainsnak"))).alias("P31")))
    title = F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).when(F.col("o_orderkey") % 5 != 1, F.concat(F.lit("An order "), F.col("o_orderkey")))
    entity = F.struct(F.when(k != 10, F.concat(F.lit("Q"), "o_orderkey")).alias("id"), F.struct(F.struct(title.alias("title")).alias("enwiki")).alias("sitelinks"), claims.alias("claims"))
    return records.entities(_t(spark, d, "orders").select(F.to_json(entity).alias("value"))).select("qid", "title", F.explode_outer(F.element_at("claims", F.lit(INSTANCE_OF))).alias("item"))


def json_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of orders as entities; an empty or missing one has no row."""
    title = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(CATEGORY_PREFIX), F.lit("Kind "), F.col("o_orderkey")))
    lines = _t(spark, d, "orders").select(F.to_json(F.struct(F.concat(F.lit("Q"), "o_orderkey").alias("id"), F.struct(F.struct(title.alias("title")).alias("enwiki")).alias("sitelinks"))).alias("value"))
    return links.titles(records.entities(lines)).unionByName(links.titles(records.entities(lines, require_title=True)))


def link_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The sizes of groups in the three joins that resolve links."""
    found = links.link_metrics(*_world(spark, d))
    one = lambda name: found[name].withColumn("join", F.lit(name))
    return one("title_to_page").unionByName(one("page_to_category")).unionByName(one("category_to_parent"))


def page_categories(spark: SparkSession, d: str) -> DataFrame:
    up, pages, _ = _world(spark, d)
    return links.page_categories(pages, up).select("page_id", F.array_join("categories", "|").alias("categories"))


def repeated_scores(spark: SparkSession, d: str) -> DataFrame:
    return ranking.repeated(_t(spark, d, "lineitem").select("l_partkey"), "l_partkey").select("keys", "rows")


def rank_parse(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "orders").select(F.concat(F.lit("Q"), "o_orderkey", F.lit(","), (F.col("o_custkey") + F.lit(5_000_000_000)).cast("string")).alias("value"))
    return records.ranks(lines.union(spark.createDataFrame([("Entity,QRank",), ("Q1,2,3",), ("X1,2",)], "value string")))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "embeddings")
    return e.select(F.concat(F.lit("word "), "vec_id").alias("name"), (F.col("vec_id") % 2 == 0).alias("is_entity"), (F.col("vec_id") % 10).alias("doc_count"), F.col("embedding").cast("array<double>").alias("vector"))


def vectors_text(spark: SparkSession, d: str) -> DataFrame:
    return files.vector_lines(_vectors(spark, d))


def vectors_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = records.word_vectors(files.vector_lines(_vectors(spark, d)).select("value"))
    return rows.select("name", "is_entity", F.size("vector").alias("dim"), F.element_at("vector", 1).alias("first"), F.element_at("vector", -1).alias("last"))


def keyed_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "nation").select("n_nationkey", "n_name")
    return files.keyed(rows, "nation", "n_nationkey", parent="world").unionByName(files.keyed(rows.select("n_name"), "name", stringify=True))


def line_shards(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "documents").select("doc_id", F.col("text").alias("value"))
    return files.sized_shards(lines, ["doc_id"], 200_000).groupBy("shard").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))


def flatten_union(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").select("event_id", "event_type", "user_id")
    first = e.filter("event_type = 'click'").select("event_id", F.lit("click").alias("part"))
    return first.unionByName(e.filter("user_id % 2 = 0").select("event_id", F.lit("even").alias("part"))).unionByName(e.filter("event_type = 'view'").select("event_id", F.lit("view").alias("part")))


def count_global(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def entity_parents(spark: SparkSession, d: str) -> DataFrame:
    return ranking.parents(_claims(spark, d))


def ordered_limit(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


_QUERIES = [
    count_children_topn, rekey_join, metrics_distribution, resolve_links, title_counts, split_links, leaf_scores, top_leaves_per_node, node_build, split_ready_pending, category_index_done,
    category_index_cyclic, category_index_cutoff, category_index_from_links, ancestors_min_depth, ancestors_cyclic, ancestors_cutoff, entity_ancestors, dump_roundtrip_page, dump_roundtrip_categorylinks, json_claims,
    json_claim_cases, json_titles, link_metrics, page_categories, repeated_scores,
    rank_parse, vectors_text, vectors_parse, keyed_records, line_shards, flatten_union, count_global, entity_parents, ordered_limit,
]
QUERIES = {f.__name__: f for f in _QUERIES}

_RESOLVED = f"""
    select r_regionkey + {REGION} as parent, n_nationkey + {NATION} as child, true as child_is_cat from nation join region on n_regionkey = r_regionkey
    union all select n_nationkey + {NATION}, c_custkey, false from customer join nation on c_nationkey = n_nationkey"""
_GRAPH = """
    leaf as (select 'C' || c_custkey as leaf_id, 'N' || c_nationkey as parent, coalesce(max(o_totalprice), 0.0) as score from customer left join orders on c_custkey = o_custkey group by all),
    edge as (select 'N' || n_nationkey as child, 'R' || n_regionkey as parent from nation union select 'R' || r_regionkey, 'ROOT' from region),
    node as (select parent as node from leaf union select parent from edge)"""
_BELOW = "below(node, low) as (select node, node from node union select b.node, e.child from below b join edge e on b.low = e.parent)"
_RANK = "row_number() over (partition by node order by score desc, leaf_id)"
_STEPS = f"""
    step as (
        select cast(c_custkey as bigint) as a, cast(c_custkey // 2 as bigint) as b, 0 as i, 1 as s from customer where c_custkey > 1
        union all select s_suppkey + {ROOT}, s_nationkey + {NATION}, 1, 0 from supplier
        union all select s_suppkey + {ROOT}, s_suppkey % 7 + 1, 0, 1 from supplier
        union all select n_nationkey + {NATION}, n_regionkey + {REGION}, 1, 0 from nation)"""


def _walks(most: int) -> str:
    """Least depths over walks of up to ``most`` hops."""
    return f"""
        walk(a, b, i, s) as (select a, b, i, s from step union select w.a, t.b, w.i + t.i, w.s + t.s from walk w join step t on w.b = t.a where w.i + w.s < {most}),
        least as (select a as node, b as ancestor, min(struct_pack(t := i + s, i := i)) as m from walk group by all)"""


ORACLE_SQL = {
    "count_children_topn": "select count(*) as count, parent from (select l_suppkey as parent from lineitem union all select l_partkey from lineitem) group by parent order by count desc, parent desc limit 100",
    "rekey_join": "select l_partkey as v, o_custkey as k2 from lineitem join orders on l_orderkey = o_orderkey",
    "metrics_distribution": """
        with b as (select coalesce(x.n, 0) as a, coalesce(y.n, 0) as b from (select o_custkey as k, count(*) as n from orders group by 1) x
            full join (select c_custkey as k, count(*) as n from customer where c_acctbal > 0 group by 1) y using (k))
        select 'v_per_key' as metric, count(*) as keys, cast(sum(a) as bigint) as total, min(a) as least, max(a) as most, avg(a) as mean from b
        union all select 'keys_per_key', count(*), cast(sum(b) as bigint), min(b), max(b), avg(b) from b""",
    "resolve_links": _RESOLVED,
    "title_counts": "select (select count(*) from nation) + (select count(*) from region) as categories, (select count(*) from customer) as non_categories",
    "split_links": f"select case when child_is_cat then 'node' else 'leaf' end as kind, child, parent from ({_RESOLVED})",
    "leaf_scores": "select l_suppkey as parent, l_partkey as leaf_id, coalesce(p_retailprice, 0.0) as score from (select distinct l_suppkey, l_partkey from lineitem) left join part on p_partkey = l_partkey and p_size <= 25",
    "top_leaves_per_node": f"with {_GRAPH} select node as node_id, pos, leaf_id, score from (select parent as node, leaf_id, score, row_number() over (partition by parent order by score desc, leaf_id) as pos from leaf) where pos <= 5",
    "node_build": f"""
        with {_GRAPH}
        select parent as node_id, 'child' as kind, child as member from edge
        union all select child, 'parent', parent from edge where child in (select node from node)
        union all select parent, 'waits', child from edge
        union all select parent, 'leaf', leaf_id from (select *, row_number() over (partition by parent order by score desc, leaf_id) as pos from leaf) where pos <= 3""",
    "split_ready_pending": f"with {_GRAPH} select node as node_id, case when node in (select parent from edge) then 'pending' else 'ready' end as state from node",
    "category_index_done": f"""
        with recursive {_GRAPH}, {_BELOW}
        select node as node_id, pos, leaf_id, score from (select node, leaf_id, score, {_RANK} as pos from (select distinct b.node, l.leaf_id, l.score from below b join leaf l on b.low = l.parent)) where pos <= 20""",
    "category_index_cyclic": f"""
        with recursive {_GRAPH.replace("union select 'R' || r_regionkey, 'ROOT' from region", "union select 'R' || r_regionkey, 'ROOT' from region union select 'R0', 'N3'")},
        reach(node, low) as (select parent, child from edge union select r.node, e.child from reach r join edge e on r.low = e.parent),
        pending as (select distinct node from (select r.node from reach r join reach c on r.low = c.node and c.low = c.node union select node from reach where node = low)),
        done as (select node from node where node not in (select node from pending)),
        {_BELOW},
        have as (
            select b.node, l.leaf_id, l.score from done join below b using (node) join leaf l on b.low = l.parent
            union select p.node, l.leaf_id, l.score from pending p join leaf l on l.parent = p.node
            union select p.node, l.leaf_id, l.score from pending p join edge e on e.parent = p.node join done c on c.node = e.child join below b on b.node = e.child join leaf l on l.parent = b.low),
        ranked as (select node, leaf_id, score, {_RANK} as pos from have)
        select n.node as node_id, case when n.node in (select node from pending) then 'pending' else 'done' end as state, coalesce(pos, 0) as pos, leaf_id, score
        from node n left join (select * from ranked where pos <= 7) r on n.node = r.node""",
    "category_index_cutoff": f"""
        with recursive {_GRAPH}, {_BELOW},
        kind as (select node, case when node = 'ROOT' then 'pending' when node like 'R%' then 'ready' else 'done' end as state from node),
        have as (select node, leaf_id, score from (select distinct b.node, l.leaf_id, l.score from below b join leaf l on b.low = l.parent where b.node <> 'ROOT'))
        select node as node_id, state, 'node' as kind, 0 as pos, '' as member from kind
        union all select node, state, 'leaf', cast(pos - 1 as integer), leaf_id from (select *, {_RANK} as pos from have) join kind using (node) where pos <= 4
        union all select 'ROOT', 'pending', 'waits', cast(row_number() over (order by child) - 1 as integer), child from edge where parent = 'ROOT'""",
    "category_index_from_links": f"""
        with leaf as (select c_custkey as leaf_id, c_nationkey as n, coalesce(cast(floor(max(o_totalprice)) as double), 0.0) as score from customer left join orders on c_custkey = o_custkey group by all),
        have as (select n + {NATION} as node, leaf_id, score from leaf join nation on n = n_nationkey union all select n_regionkey + {REGION}, leaf_id, score from leaf join nation on n = n_nationkey)
        select node as node_id, pos, leaf_id, score from (select *, {_RANK} as pos from have) where pos <= 10""",
    "ancestors_min_depth": f"with recursive {_STEPS}, {_walks(64)} select node, ancestor, m.i as instances, m.t - m.i as subclasses from least",
    "ancestors_cyclic": f"""
        with recursive step as (select cast(n_nationkey as bigint) as a, cast((n_nationkey * 7 + 3) % 25 as bigint) as b, case when n_nationkey % 3 = 0 then 1 else 0 end as i, case when n_nationkey % 3 = 0 then 0 else 1 end as s from nation),
        {_walks(30)} select node, ancestor, m.i as instances, m.t - m.i as subclasses from least""",
    "ancestors_cutoff": f"with recursive {_STEPS}, {_walks(4)} select node, ancestor, m.i as instances, m.t - m.i as subclasses, m.t = 4 as frontier from least",
    "entity_ancestors": f"""
        select s_suppkey + {ROOT} as node, s_nationkey + {NATION} as ancestor, 1 as instances, 0 as subclasses from supplier
        union all select s_suppkey + {ROOT}, n_regionkey + {REGION}, 1, 1 from supplier join nation on s_nationkey = n_nationkey
        union all select n_nationkey + {NATION}, n_regionkey + {REGION}, 0, 1 from nation
        union all select r_regionkey + {REGION}, null, null, null from region""",
    "json_claim_cases": """
        select o_orderkey as qid, case o_orderkey % 5 when 0 then '' when 1 then null else 'An_order_' || o_orderkey end as title, case when o_orderkey % 11 = 0 then o_custkey end as item
        from orders where o_orderkey % 11 <> 10""",
    "json_titles": "select 'Kind_' || o_orderkey as title, true as is_cat, o_orderkey as qid from orders, range(2) where o_orderkey % 3 = 1",
    "link_metrics": f"""
        with name as (select c_custkey as id from customer union all select n_nationkey + {NATION} from nation union all select r_regionkey + {REGION} from region),
        up as (select 'N' || n_nationkey as c from customer join nation on c_nationkey = n_nationkey union all select 'R' || n_regionkey from nation),
        cat as (select c, count(u.c2) as n from (select 'N' || n_nationkey as c from nation union all select 'R' || r_regionkey from region) left join (select c as c2 from up) u on c = c2 group by c),
        linked as (select count(*) as n from up)
        select 'title_to_page' as "join", m as metric, count(*) as keys, count(*) as total, 1 as least, 1 as most, 1.0::double as mean from name, (values ('v_per_key'), ('keys_per_key')) v(m) group by m
        union all select 'page_to_category', 'v_per_key', count(*), count(*), 1, 1, 1.0::double from name
        union all select 'page_to_category', 'keys_per_key', count(*), any_value(n), 0, 1, any_value(n) / count(*) from name, linked
        union all select 'category_to_parent', 'v_per_key', count(*), cast(sum(n) as bigint), min(n), max(n), avg(n) from cat
        union all select 'category_to_parent', 'keys_per_key', count(*), count(*), 1, 1, 1.0::double from cat""",
    "page_categories": f"""
        select c_custkey as page_id, coalesce(n_name, '') as categories from customer left join nation on c_nationkey = n_nationkey
        union all select n_nationkey + {NATION}, r_name from nation join region on n_regionkey = r_regionkey union all select r_regionkey + {REGION}, '' from region""",
    "repeated_scores": "select count(*) as keys, cast(coalesce(sum(n), 0) as bigint) as rows from (select count(*) as n from lineitem group by l_partkey having count(*) > 1)",
    "dump_roundtrip_page": "select c_custkey as page_id, c_name as title, cast(c_nationkey % 3 * 7 as integer) as namespace, false as is_redirect from customer where c_custkey % 5 <> 0 and c_nationkey % 3 in (0, 2)",
    "dump_roundtrip_categorylinks": "select c_custkey as page_id, c_mktsegment as category, case when c_custkey % 4 = 1 then 'subcat' else 'page' end as cl_type from customer where c_custkey % 4 <> 0",
    "json_claims": """
        select o_orderkey as qid, 'Order_' || o_orderkey as title, o_orderpriority as label, 2 as sitelinks, pid, item from orders join (
            select l_orderkey, 31 as pid, l_suppkey as item from lineitem where l_suppkey % 2 = 1 union all select l_orderkey, 279, l_partkey from lineitem) on o_orderkey = l_orderkey""",
    "rank_parse": "select o_orderkey as qid, o_custkey + 5000000000 as qrank from orders",
    "vectors_text": """
        select 0 as pos, count(*) || ' ' || max(len(embedding)) as value from embeddings
        union all select 1, (case when vec_id % 2 = 0 then 'ENTITY/' else '' end) || 'word_' || vec_id || ' ' || array_to_string(list_transform(embedding, lambda x: printf('%.4f', x::double)), ' ') from embeddings""",
    "vectors_parse": "select 'word_' || vec_id as name, vec_id % 2 = 0 as is_entity, len(embedding) as dim, cast(printf('%.4f', embedding[1]::double) as double) as first, cast(printf('%.4f', embedding[-1]::double) as double) as last from embeddings",
    "keyed_records": """
        with n as (select n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' as whole, '{"n_name":"' || n_name || '"}' as name from nation)
        select 'nation' as kind, cast(n_nationkey as varchar) as key, 'world' as parent, whole as properties from n
        union all select 'name', sha1(name), null, '{"content":"' || replace(name, '"', '\\"') || '"}' from n""",
    "line_shards": "select cast(floor((upto - size) / 200000) as bigint) as shard, count(*) as lines, cast(sum(size) as bigint) as chars from (select length(text) as size, sum(length(text)) over (order by doc_id) as upto from documents) group by 1",
    "flatten_union": "select event_id, 'click' as part from events where event_type = 'click' union all select event_id, 'even' from events where user_id % 2 = 0 union all select event_id, 'view' from events where event_type = 'view'",
    "count_global": "select count(*) as n from lineitem",
    "entity_parents": "select l_suppkey as parent from lineitem union all select l_partkey from lineitem",
    "ordered_limit": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50",
}
