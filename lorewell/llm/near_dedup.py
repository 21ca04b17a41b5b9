"""MinHash near-dedup with tensored banding.

Texts become sets of hashed five-word shingles. Texts with equal sets are one
node from then on. Minhashes form two collections of ``COLLECTION`` sub-keys,
each of ``WIDTH`` minhashes; a table is a pair of a sub-key of one collection
and a sub-key of the other, so ``COLLECTION ** 2`` tables with keys of
``2 * WIDTH`` minhashes cost ``2 * COLLECTION * WIDTH`` minhashes. At a similarity of
0.75 a pair meets in no table with a probability below 2e-5.

Sub-keys that only one node has can't meet; they go before pairs of sub-keys are
formed. Candidates are verified in two steps, on full sets. First, in each bucket
every node is compared with the smallest one, and linked nodes form components;
buckets that share the smallest node and the sub-key of the first collection
are one from there on. Then, where buckets still hold several components, their
nodes meet once more by that sub-key, in cells of bounded size: the
nodes outside the largest component there ask all others. A cell sees the sets
themselves and gives one link for a node and component, so no pair of a group
is ever a row; what isn't compared is linked already.

Edge cases. A null or wordless text has an empty set, links with nothing and is
kept. Fewer than five words make one shingle. Rows with a null id take no part:
their component is null and they are kept. Rows repeating an id are one
document; its texts share a component. Repeated texts under other ids link. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, checkpointed, forget, likely_in, mix, slices, small_batches, text_blocks, windows, without

WIDTH, COLLECTION, SHINGLE = 3, 22, 5
HASHES = 2 * WIDTH * COLLECTION
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair of which fewer minhashes are equal isn't compared; at a similarity of 0.75 that has a probability below 3e-7.
LEAST_EQUAL = 73
#: Bytes of sets of the asking and of the answering nodes of a cell, on average.
ASK_BYTES, ANSWER_BYTES = 1 << 19, 1 << 20
#: Tasks that share the nodes of a sub-key before they are dealt to cells.
SALTS = 32

SKETCH = "doc_id long, n_shingles long, mark binary, subs array<long>"


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    for _, data, offsets in text_blocks(texts):
        words = Words(data, offsets, lower=True)
        runs = windows(words, SHINGLE)
        for n, at in zip(words.counts.tolist(), words.bounds.tolist(), strict=False):
            if n >= SHINGLE:
                yield np.unique(runs[at : at + n - SHINGLE + 1])
            elif n:
                h = np.array([n], dtype=np.uint64)
                for w in words.hash[at : at + n]:
                    h = mix(h ^ w)
                yield h
            else:
                yield np.zeros(0, np.uint64)


def coefficients() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the minhashes: columns."""
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)).astype(np.uint32)[:, None]
    return seeds[:HASHES] | np.uint32(1), seeds[HASHES:]


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """Minhashes of non-empty sets, 32 bits each: a row for each set."""
    a, b = coefficients()
    out = np.full((len(sets), HASHES), 0xFFFFFFFF, dtype=np.uint32)
    for k, s in enumerate(sets):
        low = (s >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(low), 2048):
            np.minimum(out[k], (low[at : at + 2048] * a + b).min(1), out=out[k])
    return out


def sub_keys(mins: np.ndarray) -> np.ndarray:
    """The sub-keys of both collections, a row of 2 * COLLECTION longs for each row of minhashes.

    A long has WIDTH minhashes of 16 bits, and above them the sub-key's number.
    """
    short = (mins * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint64)
    keys = np.tile(np.arange(2 * COLLECTION, dtype=np.uint64), (len(mins), 1))
    for k in range(WIDTH):
        keys = keys << np.uint64(16) | short[:, k::WIDTH]
    return keys.astype(np.int64)


def equal_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minhashes agree, by row of the sub-keys a and b."""
    lanes = (np.ascontiguousarray(x).view("<u2") for x in (a, b))
    return np.equal(*lanes).sum(-1) - 2 * COLLECTION  # one lane in four is the number


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        full = [k for k, s in enumerate(sets) if len(s)]
        marks, subs = [None] * len(sets), [None] * len(sets)
        if full:
            keys = sub_keys(minhashes([sets[k] for k in full]))
            for j, k in enumerate(full):
                s = sets[k]
                marks[k] = np.array([s.sum(), mix(s + np.uint64(7)).sum()], dtype=np.uint64).tobytes()
                subs[k] = keys[j]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), pa.array(subs, pa.list_(pa.int64()))],
            [c.split()[0] for c in SKETCH.split(", ")],
        )


def _rows(lists: pa.Array) -> np.ndarray:
    """Lists of sub-keys as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * COLLECTION)


def _near_sizes(n: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """Whether sets of n and m shingles can be linked: the union is as large as the larger at least, the intersection as large as the smaller at most."""
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (x, y, n_x, n_y, s_x, s_y) those that sizes and minhashes don't rule out."""
    for batch in batches:
        if batch.num_rows:
            n_x, n_y = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            ok = _near_sizes(n_x, n_y) & (equal_hashes(_rows(batch.column(4)), _rows(batch.column(5))) >= LEAST_EQUAL)
            yield batch.select([0, 1]).filter(pa.array(ok))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    every = np.concatenate([a, b])
    every.sort(kind="stable")  # merges two sorted runs
    both = int((every[1:] == every[:-1]).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())], ["node", "shingles"]), 64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (y, part, x, shingles), sorted by y and part, the null x first: its set is y's."""
    now, own = None, []
    for batch in batches:
        ys, parts, xs = (batch.column(k).to_pylist() for k in range(3))
        found: list[tuple[int, int]] = []
        for y, part, x, raw in zip(ys, parts, xs, batch.column(3).to_pylist(), strict=True):
            s = np.frombuffer(raw, dtype=np.uint64)
            if (y, part) != now:
                now, own = (y, part), []
            if x is None:
                own.append(s)
            elif any(linked(s, o) for o in own):
                found.append((x, y))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["x", "y"])


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) that are linked; sets: node, shingles. Ranges of pairs by y and x, so a node with many partners is in several."""
    placed = checkpointed(pairs.repartitionByRange("y", "x").select("x", "y", F.spark_partition_id().alias("part")))
    asked = placed.select("y", "part", "x", F.col("x").alias("node")).unionByName(placed.select("y", "part").distinct().select("y", "part", F.lit(None).cast("long").alias("x"), F.col("y").alias("node")))
    rows = asked.join(sets.select("node", "shingles"), "node").select("y", "part", "x", "shingles")
    edges = checkpointed(rows.repartition("y", "part").sortWithinPartitions("y", "part", F.col("x").asc_nulls_first()).mapInArrow(_compare, "x long, y long"))
    forget(placed)
    return edges


def _cell(cell: pa.Table) -> pa.Table:
    """Rows (asks, node, label, subs, shingles) -> links (x, y) between components, one at most for an asking node and another component."""
    asks = cell.column("asks").to_numpy()
    node, label = cell.column("node").to_numpy(), cell.column("label").to_numpy()
    xs: list[int] = []
    ys: list[int] = []
    inner, outer = np.flatnonzero(asks), np.flatnonzero(~asks)
    if len(inner) and len(outer):
        subs = _rows(cell.column("subs").combine_chunks())
        raw = cell.column("shingles").to_pylist()
        size = np.array([len(r) // 8 for r in raw])
        # The answering sets as numbers of their distinct shingles, so one look-up compares an asking set with all.
        known, number = np.unique(np.concatenate([np.frombuffer(raw[k], dtype=np.uint64) for k in outer]), return_inverse=True)
        stops = np.concatenate([[0], np.cumsum(size[outer])])
        others, other_labels, other_sizes = subs[outer], label[outer], size[outer]
        for u in inner.tolist():
            near = np.flatnonzero((other_labels != label[u]) & _near_sizes(other_sizes, size[u]))
            near = near[equal_hashes(others[near], subs[u]) >= LEAST_EQUAL]
            if not len(near):
                continue
            own = np.frombuffer(raw[u], dtype=np.uint64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            has = np.zeros(len(known), dtype=np.int64)
            has[at[known[at] == own]] = 1
            if 4 * len(near) > len(outer):
                both = np.add.reduceat(has[number], stops[:-1])[near]
            else:
                both = np.array([has[number[stops[v] : stops[v + 1]]].sum() for v in near])
            met = near[100 * both >= PERCENT * (size[u] + other_sizes[near] - both)]
            for v in met[np.unique(other_labels[met], return_index=True)[1]]:
                xs.append(int(node[u]))
                ys.append(int(node[outer[v]]))
    return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})


def _open_links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, of the nodes in groups: a (the group's name), node, label; sets: node, subs, shingles."""
    weight = F.octet_length("shingles") + F.lit(8 * 2 * COLLECTION)
    weighed = checkpointed(groups.join(sets.select("node", weight.alias("weight")), "node"))
    by_label = weighed.groupBy("a", "label").agg(F.sum("weight").alias("weight"))
    every = F.sum("weight")
    plan = by_label.groupBy("a").agg(
        F.max_by("label", F.struct("weight", "label")).alias("main"), F.ceil((every - F.max("weight")) / ASK_BYTES).cast("int").alias("ask"), F.ceil(every / ANSWER_BYTES).cast("int").alias("answer"))
    # Copies of the plan, so that a large group's nodes find it in several tasks; as many as nodes, so they are not broadcast.
    copies = plan.filter("ask > 0").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # A block of asking nodes meets each block of all the group's nodes in one cell.
    placed = weighed.withColumn("hash", F.xxhash64("node")).withColumn("salt", F.pmod(F.shiftright("hash", 32), F.lit(SALTS)).cast("int")).join(copies.hint("merge"), ["a", "salt"])
    block = lambda c: F.pmod("hash", F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asking = placed.filter("label <> main").select("a", block("ask").alias("i"), each("answer").alias("j"), F.lit(True).alias("asks"), "node", "label")
    answering = placed.select("a", each("ask").alias("i"), block("answer").alias("j"), F.lit(False).alias("asks"), "node", "label")
    cells = asking.unionByName(answering).join(sets, "node").groupBy("a", "i", "j").applyInArrow(_cell, "x long, y long")
    links = checkpointed(cells.distinct())
    forget(weighed)
    return links


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each node of the edges (x, y) reaches: node, label."""
    both = checkpointed(edges.select(F.col("x").alias("node"), F.col("y").alias("other")).unionByName(edges.select(F.col("y").alias("node"), F.col("x").alias("other"))).distinct())
    now = checkpointed(both.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("label")))
    while True:
        near = both.join(now.select(F.col("node").alias("other"), F.col("label").alias("l")), "other").groupBy("node").agg(F.min("l").alias("l"))
        step = now.select("node", "label").join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("l"))
        new = checkpointed(step.join(jump, "label", "left").select("node", "was", F.least("label", "l").alias("label")))
        forget(now)
        now = new
        if new.filter("label <> was").limit(1).count() == 0:
            forget(both)
            return new


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sketches = checkpointed(rows.mapInArrow(_sketch, SKETCH))
    full = sketches.filter("mark is not null and doc_id is not null")
    # Equal sets are one node, named by the smallest id.
    nodes = checkpointed(full.groupBy("mark", "n_shingles").agg(F.min(F.struct("doc_id", "subs")).alias("first")).select(F.col("first.doc_id").alias("node"), "mark", "n_shingles", "first.subs"))

    subs = nodes.select("node", F.explode("subs").alias("sub"))
    shared = checkpointed(subs.groupBy("sub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("sub"))
    side = lambda c: F.collect_list(F.when(c, F.col("sub")))
    second = F.col("sub") >= COLLECTION << 16 * WIDTH
    sides = likely_in(subs, "sub", shared).join(shared, "sub", "left_semi").groupBy("node").agg(side(~second).alias("a"), side(second).alias("b"))
    keys = sides.select("node", F.explode("a").alias("a"), "b").select("node", "a", F.explode("b").alias("b")).select("node", "a", F.xxhash64("a", "b").alias("key"))
    # Copies of a group meet in many tables: of buckets with the same nodes one is enough.
    mark = lambda seed: F.bit_xor(F.xxhash64("node", F.lit(seed)))
    every = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub"), F.max("node").alias("last"), mark(1).alias("m1"), mark(2).alias("m2")).filter("n > 1")
    hubs = checkpointed(every.groupBy("n", "hub", "last", "m1", "m2").agg(F.min("key").alias("key")).filter("hub <> last"))
    # Every node there is compared with the smallest one, so buckets of a sub-key with the same smallest node are one: far fewer rows than keys.
    buckets = checkpointed(keys.join(hubs.filter("n > 2").select("key", "hub"), "key").select("a", "node", "hub").distinct())
    stars = checkpointed(hubs.filter("n = 2").select(F.col("last").alias("x"), F.col("hub").alias("y")).unionByName(buckets.filter("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y"))).distinct())
    forget(shared, hubs)
    inside = checkpointed(stars.select("x").union(stars.select("y")).distinct().toDF("node"))
    texts = likely_in(rows, "doc_id", inside).select(F.col("doc_id").alias("node"), "text").join(inside, "node", "left_semi").mapInArrow(_full_sets, "node long, shingles binary")
    # An id with several texts has as many sets; none of them is lost.
    sets = checkpointed(texts.join(nodes.select("node", "subs").join(inside, "node", "left_semi"), "node"))
    facts = nodes.join(inside, "node", "left_semi")
    with_x = stars.join(facts.select(F.col("node").alias("x"), F.col("n_shingles").alias("n_x"), F.col("subs").alias("s_x")), "x")
    with_y = with_x.join(facts.select(F.col("node").alias("y"), F.col("n_shingles").alias("n_y"), F.col("subs").alias("s_y")), "y")
    likely = checkpointed(with_y.select("x", "y", "n_x", "n_y", "s_x", "s_y").mapInArrow(_likely, "x long, y long"))
    edges = _compared(likely, sets)
    labels = components(edges)
    forget(stars, inside, likely, edges)

    # What is left open: buckets with several components.
    known = checkpointed(buckets.join(labels, "node", "left").select("a", "hub", "node", F.coalesce("label", "node").alias("label")))
    several = known.groupBy("a", "hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("a", "hub")
    more = _open_links(known.join(several, ["a", "hub"], "left_semi").select("a", "node", "label").distinct(), sets)
    forget(buckets, known, sets)
    if more.limit(1).count():
        # Components of components: a small graph.
        to = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l_{c}"))
        ends = checkpointed(more.join(to("x"), "x", "left").join(to("y"), "y", "left").select(F.coalesce("l_x", "x").alias("x"), F.coalesce("l_y", "y").alias("y")))
        joined = components(ends)
        again = joined.select(F.col("node").alias("was"), F.col("label").alias("now"))
        moved = labels.select("node", "label").join(again, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label"))
        labels = checkpointed(moved.unionByName(joined.select("node", "label").join(labels, "node", "left_anti")))

    names = nodes.select("mark", "n_shingles", "node").join(labels.select("node", "label"), "node", "left").select("mark", "n_shingles", F.coalesce("label", "node").alias("label"))
    placed = full.select("doc_id", "n_shingles", "mark").join(names, ["mark", "n_shingles"]).select("doc_id", "n_shingles", F.col("label").alias("component_id"))
    alone = sketches.filter("mark is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that a smaller id of their group stands for; of rows repeating an id one stays."""
    gone = checkpointed(near_dedup(docs, id_col, text_col).filter("not kept").select("doc_id"))
    left = without(docs, id_col, gone)
    twice = checkpointed(docs.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"))
    if twice.limit(1).count() == 0:
        return left
    return without(left, id_col, twice).unionByName(likely_in(left, id_col, twice).join(twice.withColumnRenamed("doc_id", "__twice"), F.col(f"`{id_col}`").cast("long") == F.col("__twice"), "left_semi").dropDuplicates([id_col]))


def near_dedup_sql() -> str:
    """The query's rows by DuckDB, from the plain definition: all pairs that share a shingle."""
    return f"""
        with recursive d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as (
            select doc_id, case when len(w) = 0 then [] when len(w) < {SHINGLE} then [array_to_string(w, ' ')]
                else list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) end as sh from d),
        n as materialized (select doc_id, len(sh) as n from s),
        e as materialized (select doc_id, unnest(sh) as x from s),
        p as (select a.doc_id as a, b.doc_id as b, count(*) as i from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
        l as materialized (
            select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * i >= {PERCENT} * (na.n + nb.n - i)),
        both_ways as materialized (select a, b from l union all select b, a from l),
        r(doc_id, other) as (select doc_id, doc_id from n union select r.doc_id, b from r join both_ways on r.other = a)
        select n.doc_id, n.n as n_shingles, c.m as component_id, n.doc_id = c.m as kept
        from n join (select doc_id, min(other) as m from r group by doc_id) c using (doc_id)
    """
