"""The leaf index, ancestors and resolved links: brute-force versions on graphs made by seed, and a few cases by hand."""

import random
from collections import Counter, defaultdict

import pytest

from lorewell.operators import links, ranking
from lorewell.plans import ancestors, leaf_index
from lorewell.sources import samples


def index_of(frame):
    return {r["node_id"]: r for r in frame.collect()}


def graph(spark, leaves, leaf_links, node_links):
    return (
        spark.createDataFrame(leaves, "leaf_id string, score double"),
        spark.createDataFrame(leaf_links, "leaf_id string, parent string"),
        spark.createDataFrame(node_links, "child string, parent string"),
    )


def names(row):
    return [x["leaf_id"] for x in row["top_leaves"]]


#: Springs feed creeks, creeks feed rivers; the number is the flow.
SPRINGS = [("alder", 3.5), ("birch", 3.5), ("cedar", 12.0), ("dogwood", 0.25), ("elm", 7.0)]
FEEDS = [("alder", "mill"), ("birch", "mill"), ("cedar", "mill"), ("dogwood", "stone"), ("elm", "stone"), ("elm", "delta"), ("alder", "mill")]
FLOWS = [("mill", "delta"), ("stone", "delta"), ("stone", "mill")]


def test_nodes(spark):
    got = index_of(leaf_index.create_nodes(*graph(spark, SPRINGS, FEEDS, FLOWS), n=2))
    assert {k: names(r) for k, r in got.items()} == {"mill": ["cedar", "alder"], "stone": ["elm", "dogwood"], "delta": ["elm"]}
    assert {k: r["unprocessed_children"] for k, r in got.items()} == {"mill": ["stone"], "stone": [], "delta": ["mill", "stone"]}
    assert got["stone"]["parents"] == ["delta", "mill"] and got["delta"]["children"] == ["mill", "stone"]
    pending, ready = leaf_index.split_ready(leaf_index.create_nodes(*graph(spark, SPRINGS, FEEDS, FLOWS)))
    assert set(index_of(pending)) == {"mill", "delta"} and set(index_of(ready)) == {"stone"}


def test_index(spark):
    index = leaf_index.create_index(*graph(spark, SPRINGS, FEEDS, FLOWS))
    got = index_of(index.done)
    assert names(got["delta"]) == names(got["mill"]) == ["cedar", "elm", "alder", "birch", "dogwood"]
    assert index.pending.count() == index.ready.count() == 0


def test_children_that_are_no_nodes(spark):
    world = graph(spark, SPRINGS, FEEDS, [*FLOWS, ("dry bed", "stone")])
    assert set(index_of(leaf_index.create_index(*world).pending)) == {"mill", "stone", "delta"}
    assert set(index_of(leaf_index.create_index(*world, prune_empty_children=True).done)) == {"mill", "stone", "delta"}


def test_index_with_a_whirl(spark):
    """Two creeks that feed each other wait for ever, and so does what lies below them."""
    index = leaf_index.create_index(*graph(spark, SPRINGS, FEEDS, [("stone", "mill"), ("mill", "eddy"), ("eddy", "mill"), ("eddy", "sea")]))
    assert {k: names(r) for k, r in index_of(index.done).items()} == {"stone": ["elm", "dogwood"], "delta": ["elm"]}
    pending = index_of(index.pending)
    assert {k: r["unprocessed_children"] for k, r in pending.items()} == {"mill": ["eddy"], "eddy": ["mill"], "sea": ["eddy"]}
    assert names(pending["mill"]) == ["cedar", "elm", "alder", "birch", "dogwood"] and names(pending["sea"]) == []


def closed_form(leaves, leaf_links, node_links, iters, n):
    """Heights and leaves by recursion on sets."""
    score = defaultdict(float)
    for leaf, s in leaves:
        score[leaf] = max(score.get(leaf, s), s)
    nodes = {p for _, p in leaf_links} | {p for _, p in node_links}
    children = defaultdict(set)
    for c, p in node_links:
        children[p].add(c)
    height = {k: 0 for k in nodes if not children[k]}
    for _ in range(len(nodes) + 1):
        for k in nodes:
            if k not in height and all(c in height for c in children[k]):
                height[k] = 1 + max(height[c] for c in children[k])
    own = defaultdict(set)
    for leaf, p in leaf_links:
        own[p].add(leaf)

    def below(k):
        return own[k].union(*(below(c) for c in children[k])) if k in height else own[k].union(*(below(c) for c in children[k] if height.get(c, iters) < iters))

    def one(k):
        h = height.get(k)
        if h is not None and h <= iters:
            got = below(k)
        else:
            got = own[k].union(*(below(c) for c in children[k] if height.get(c, iters) < iters))
        waits = sorted(c for c in children[k] if height.get(c, iters) >= iters)
        state = "pending" if h is None or h > iters else "ready" if h == iters else "done"
        return state, sorted(got, key=lambda x: (-score[x], x))[:n], waits

    return {k: one(k) for k in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_index_against_the_closed_form(spark, seed):
    rng = random.Random(seed)
    ids = [f"n{k:02d}" for k in range(14)]
    leaves = [(f"l{k:02d}", float(rng.randint(0, 5))) for k in range(20) if rng.random() < 0.8]
    leaf_links = [(f"l{rng.randint(0, 19):02d}", rng.choice(ids[:10])) for _ in range(30)]
    node_links = []
    for _ in range(18):
        a, b = sorted(rng.sample(range(14), 2))
        node_links.append((ids[a], ids[b]) if rng.random() < 0.93 else (ids[b], ids[a]))
    iters, n = 3, 4
    index = leaf_index.create_index(*graph(spark, leaves, leaf_links, node_links), iters=iters, n=n)
    got = {r["node_id"]: (state, names(r), r["unprocessed_children"]) for state, frame in index._asdict().items() for r in frame.collect()}
    assert got == closed_form(leaves, leaf_links, node_links, iters, n)


def test_category_index_of_the_samples(spark):
    index = leaf_index.create_category_index(samples.links(spark), samples.pages(spark), samples.entities(spark), samples.ranks(spark))
    got = index_of(index.done)
    rank = {k: float(r) for k, _, _, r in samples.WORLD if r}
    family = {name: k for k, name, _, r in samples.WORLD if r is None}
    members = defaultdict(list)
    for k, _, group, r in samples.WORLD:
        if r:
            members[family[group]].append(k)
            members[family["Instruments"]].append(k)
    assert {k: [(x["leaf_id"], x["score"]) for x in r["top_leaves"]] for k, r in got.items()} == {k: sorted(((m, rank[m]) for m in ms), key=lambda x: -x[1]) for k, ms in members.items()}
    assert got[204]["children"] == [201, 202, 203] and got[201]["parents"] == [204]
    resolved = {tuple(r) for r in links.resolve_links(samples.links(spark), samples.pages(spark), samples.entities(spark)).collect()}
    assert resolved == {(family[group], k, r is None) for k, _, group, r in samples.WORLD if group}
    assert {r["page_id"]: r["categories"] for r in links.page_categories(samples.pages(spark), samples.links(spark)).collect()} == {k: [group] if group else [] for k, _, group, _ in samples.WORLD}


def test_top_parents(spark):
    rng = random.Random(4)
    claims = [(k, rng.choice([None, {}, {p: [rng.randint(900, 920) for _ in range(rng.randint(0, 4))] for p in (31, 279, 17)}])) for k in range(80)]
    count = Counter(x for _, c in claims for p in (31, 279) for x in (c or {}).get(p, []))
    got = ranking.top_parents(spark.createDataFrame(claims, "qid long, claims map<int,array<long>>"), 6)
    assert [tuple(r) for r in got.collect()] == sorted(((n, p) for p, n in count.items()), reverse=True)[:6]


def gathered(spark, rows, kind="string", **more):
    frame = spark.createDataFrame(rows, f"node_id {kind}, instance_of array<{kind}>, subclass_of array<{kind}>")
    return {r["node_id"]: {k: tuple(v) for k, v in r["ancestors"].items()} for r in ancestors.gather_ancestors(frame, **more).collect()}


def least_depths(rows):
    """(instances, subclasses) of the shortest walks, by relaxing until nothing changes."""
    step = {}
    for node, above, over in rows:
        for targets, cost in ((above, (1, 1)), (over, (1, 0))):  # hops, instance hops
            for t in targets:
                step[node, t] = min(step.get((node, t), cost), cost)
    best = dict(step)
    while True:
        new = dict(best)
        for (a, b), (h, i) in best.items():
            for (c, d), (h2, i2) in step.items():
                if b == c:
                    new[a, d] = min(new.get((a, d), (10**6, 0)), (h + h2, i + i2))
        if new == best:
            break
        best = new
    return {node: {b: (i, h - i) for (a, b), (h, i) in best.items() if a == node} for node, _, _ in rows}


@pytest.mark.parametrize("seed", [3, 4])
def test_ancestors_against_relaxation(spark, seed):
    """Graphs with cycles and with targets that are no nodes."""
    rng = random.Random(seed)
    pick = lambda: [rng.randint(0, 15) for _ in range(rng.choice((0, 0, 1, 1, 2)))]
    rows = [(k, pick(), pick()) for k in range(12)]
    assert gathered(spark, rows, "long") == least_depths(rows)


def test_ancestors_by_hand(spark):
    rows = [("teapot", ["pot"], ["vessel"]), ("pot", [], ["vessel"]), ("vessel", ["object"], [])]
    got = gathered(spark, rows)
    assert got["teapot"] == {"pot": (1, 0), "vessel": (0, 1), "object": (1, 1)}
    assert got["pot"] == {"vessel": (0, 1), "object": (1, 1)} and got["vessel"] == {"object": (1, 0)}


def test_ancestors_cut_off(spark):
    frame = spark.createDataFrame([(k, [], [k + 1]) for k in range(20)], "node_id long, instance_of array<long>, subclass_of array<long>")
    got = {r["node_id"]: r for r in ancestors.gather_ancestors(frame, iterations=3).collect()}
    assert sorted(got[0]["ancestors"]) == list(range(1, 9)) and got[0]["unprocessed_ancestors"] == [8]


def test_repeated(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("c", 0.0), ("c", 0.0), ("c", 5.0)], "leaf_id string, score double")
    assert tuple(ranking.repeated(rows, "leaf_id").first()) == (2, 5)


def test_empty_inputs(spark):
    index = leaf_index.create_index(*graph(spark, [], [], []))
    assert index.done.count() == index.pending.count() == index.ready.count() == 0
    assert gathered(spark, []) == {}
