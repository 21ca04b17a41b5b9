"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks. With weight w, a source's block j (from 1)
is released at slot floor((j - 1) / w) and due at slot ceil(j / w); every slot
goes to the released block with the earliest deadline. At every slot a source
is then less than one block from its target. Weights are integer parts, so the
schedule repeats after as many slots as there are parts and one period of it,
of a bounded size, serves any number of blocks. When a source runs out, the
rest go on with their weights scaled up; deviations count from there.

Every document is kept, once. Its place is (slot, place in the block).

Edge cases. A null source is a source of its own, named null, with the default
parts. Sources beyond the named ones get the default parts. If there are more
than ``SOURCES`` sources, those with as many parts form a class, which is mixed as one source with
the sum of the parts of its members that have blocks left. Its blocks are its members' in turn,
so a source is then less than two blocks from its target. The order within a source is that of a hash of id and text, then the
id, then a hash of the text; rows alike in all these are interchangeable. An empty table
gives an empty result. Input columns are kept; result columns that clash with
them replace them.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, fits

#: Documents of a block.
BLOCK = 64
#: Sources that are scheduled one by one; of more, no list is made in one place.
SOURCES = 1024
#: Sum of all sources' parts, at most.
PARTS = 1 << 20
#: Places of all phases of a schedule, at most: what the driver makes and tasks are sent.
PLACES = 1 << 22
#: Rows of a bucket, on average: what one task ranks.
BUCKET_ROWS = 8_192


def period(parts: list[int], slots: int | None = None) -> list[int]:
    """The source of each slot of one period, or of its first slots, by earliest deadline among released blocks; ties to the lower index."""
    total = sum(parts)
    slots = total if slots is None else min(slots, total)
    waiting: list[list[int]] = [[] for _ in range(total + 1)]  # by release: sources
    done = [0] * len(parts)
    for s, w in enumerate(parts):
        if w:
            waiting[0].append(s)
    ready: list[tuple[int, int]] = []
    out = []
    for slot in range(slots):
        for s in waiting[slot]:
            heapq.heappush(ready, (-(-(done[s] + 1) * total // parts[s]), s))
        _, s = heapq.heappop(ready)
        out.append(s)
        done[s] += 1
        if done[s] < parts[s]:
            # A block released before the next slot competes from there on.
            waiting[max(slot + 1, done[s] * total // parts[s])].append(s)
    return out


def phases(parts: list[int], blocks: list[int]) -> list[dict]:
    """What each source does until it or another runs out; parts and blocks by source."""
    return staged([[(w, n)] for w, n in zip(parts, blocks, strict=True)])


def staged(stages: list[list[tuple[int, int]]]) -> list[dict]:
    """The same for sources whose parts change: by source, parts and how many blocks are mixed with them, in turn.

    A phase has at most a period's places, and at most one for each of its slots; all have at most ``PLACES``.

    Rows: source, from_block (its first block of the phase), n_blocks, slot (the
    phase's first), total (slots of a period), quota (its slots in one), at (their places).
    """
    todo = [[x for x in reversed(s) if x[1]] for s in stages]
    left, begun, slot, out, held = [s[-1][1] if s else 0 for s in todo], [0] * len(todo), 0, [], 0
    while any(left):
        active = [s[-1][0] if s else 0 for s in todo]
        common = math.gcd(*active)
        active = [w // common for w in active]
        total = sum(active)
        table = period(active, sum(left))
        places: list[list[int]] = [[] for _ in todo]
        for k, s in enumerate(table):
            places[s].append(k)
        # The slot after a source's last block, whichever comes first. One without a place for it ends later.
        ends = [(n - 1) // w * total + places[s][(n - 1) % w] + 1 for s, (n, w) in enumerate(zip(left, active, strict=True)) if w and (n - 1) % w < len(places[s])]
        end = min(ends)
        full, rest = divmod(end, total)
        given = [full * w + bisect.bisect_left(places[s], rest) for s, w in enumerate(active)]
        held += min(total, end)
        if held > PLACES:
            raise ValueError(f"the schedule has more than {PLACES} places; name fewer or coarser parts")
        out += [{"source": s, "from_block": begun[s], "n_blocks": g, "slot": slot, "total": total, "quota": active[s], "at": places[s] if full else places[s][:g]} for s, g in enumerate(given) if g]
        left = [n - g for n, g in zip(left, given, strict=True)]
        begun = [b + g for b, g in zip(begun, given, strict=True)]
        slot += end
        for k, s in enumerate(todo):
            if s and not left[k]:
                s.pop()
                left[k] = s[-1][1] if s else 0
    return out


def _ranked(docs: DataFrame, parts: dict[str, int], default: int, block: int, source_col: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The documents with their source, rank in it and bucket, the sources' counts and, if there are many, their turns.

    Ranks come in two steps, as one source may hold most rows: within hashed
    buckets, then by the sums of the buckets before.
    """
    with_key = docs.select("*", F.col(f"`{source_col}`").cast("string").alias("__class"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("__hash"), F.xxhash64(F.col(f"`{text_col}`")).alias("__text"))
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    dealt = with_key.withColumn("__bucket", F.pmod("__hash", F.lit(buckets)))
    counts = checkpointed(dealt.groupBy("__class", "__bucket").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("__class").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("__class").alias("c_class"), F.col("__bucket").alias("c_bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("c_start"))
    sizes = counts.groupBy("__class").agg(F.sum("n").alias("n"))
    if fits(sizes, SOURCES):
        turns = None
    else:
        turns = checkpointed(_turns(sizes, parts, default, block))
        starts = starts.join(turns, F.col("c_class").eqNullSafe(F.col("t_class"))).drop("t_class")
    # One shuffle by bucket, whose rows are of all sources alike, serves window and join.
    inside = Window.partitionBy("__bucket", "__class").orderBy("__hash", F.col(f"`{id_col}`"), "__text")
    ranked = dealt.repartition(F.col("__bucket")).withColumn("__in", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, (F.col("__bucket") == F.col("c_bucket")) & F.col("__class").eqNullSafe(F.col("c_class")))
    return joined.withColumn("__rank", F.col("c_start") + F.col("__in")).drop("c_class", "c_bucket", "c_start", "__in", "__bucket", "__hash", "__text"), sizes, turns


def _turns(sizes: DataFrame, parts: dict[str, int], default: int, block: int) -> DataFrame:
    """t_class, t_parts, t_blocks and t_turn: the source's place among those with as many parts, more blocks first.

    So the sources that still have a block number b are the first of their
    class, and each has the same turn in every round. Turns come in two steps, as most
    sources may have as many blocks.
    """
    given = sizes.sparkSession.createDataFrame(list(parts.items()), "g_class string, g_parts long")
    known = sizes.join(given, F.col("__class") == F.col("g_class"), "left").select(
        F.col("__class").alias("t_class"), F.coalesce("g_parts", F.lit(default)).cast("long").alias("t_parts"), F.ceil(F.col("n") / block).cast("long").alias("t_blocks"), F.xxhash64("__class").alias("hash")
    )
    known = checkpointed(known.withColumn("bucket", F.pmod("hash", F.lit(max(1, -(-sizes.count() // BUCKET_ROWS))))))
    before = Window.partitionBy("t_parts").orderBy(F.desc("t_blocks"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = known.groupBy("t_parts", "t_blocks", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("t_parts", "t_blocks", "bucket").orderBy("hash", "t_class")
    return known.withColumn("in", F.row_number().over(inside) - 1).join(starts, ["t_parts", "t_blocks", "bucket"]).select("t_class", "t_parts", "t_blocks", (F.col("start") + F.col("in")).alias("t_turn"))


def mix(docs: DataFrame, parts: dict[str, int], default: int = 1, block: int = BLOCK, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with ``block`` (number in its source, from 0), ``slot`` and ``place`` (in the block)."""
    ranked, counts, turns = _ranked(docs, parts, default, block, source_col, id_col, text_col)
    keep = [c for c in docs.columns if c not in {"block", "slot", "place"}]
    #: By class (a source, or sources with as many parts): parts and blocks of its stages.
    stages: list[list[tuple[int, int]]] = []
    #: By class: the first block number of each stage, the class's blocks before it, and its live sources.
    rounds: list[list[tuple[int, int, int]]] = []
    if turns is None:
        sizes = sorted(((r["__class"], r["n"]) for r in counts.collect()), key=lambda r: (r[0] is None, r[0] or ""))
        classes = [name for name, _ in sizes]
        weights = [parts.get(name, default) if name is not None else default for name in classes]
        stages = [[(w, -(-n // block))] for w, (_, n) in zip(weights, sizes, strict=True)]
        rounds = [[(0, 0, 1)] for _ in sizes]
        key = F.col("__class")
    else:
        # As many rows as there are different numbers of blocks, about the root of all blocks at most.
        by_parts: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for r in turns.groupBy("t_parts", "t_blocks").count().collect():
            by_parts[r["t_parts"]].append((r["t_blocks"], r["count"]))
        weights = sorted(by_parts)
        classes = [str(w) for w in weights]
        for w in weights:
            live, done, total = sum(m for _, m in by_parts[w]), 0, 0
            stages.append([])
            rounds.append([])
            for n, m in sorted(by_parts[w]):
                stages[-1].append((w * live, (n - done) * live))
                rounds[-1].append((done, total, live))
                live, done, total = live - m, n, total + (n - done) * live
        key = F.col("t_parts").cast("string")
    if any(w < 1 for w in weights) or sum(weights) > PARTS:
        raise ValueError(f"parts are positive integers with a sum of at most {PARTS}")
    plan = staged(stages)
    if not plan:
        return docs.select(*(F.col(f"`{c}`") for c in keep), *(F.lit(0).cast("long").alias(c) for c in ("block", "slot", "place")))
    rows = docs.sparkSession.createDataFrame(
        [(p["source"], p["from_block"], p["n_blocks"], p["slot"], p["total"], p["quota"], p["at"]) for p in plan],
        "p_number int, p_from long, p_blocks long, p_slot long, p_total long, p_quota long, p_at array<int>",
    )
    named = docs.sparkSession.createDataFrame([(k, c, r) for k, (c, r) in enumerate(zip(classes, rounds, strict=True))], "c_number int, p_class string, r array<struct<r_from: long, r_before: long, r_live: long>>")
    # At most SOURCES rows, one a class, with its phases.
    table = rows.groupBy("p_number").agg(F.sort_array(F.collect_list(F.struct("p_from", "p_blocks", "p_slot", "p_total", "p_quota", "p_at"))).alias("p"))
    table = table.join(named, F.col("p_number") == F.col("c_number")).select("p_class", "p", "r")
    number = F.floor(F.col("__rank") / block).cast("long")
    here = F.element_at(F.filter("r", lambda r: r["r_from"] <= F.col("__block")), -1)
    # The block's number in its class: earlier stages, earlier rounds of this one, and the source's turn.
    at = F.col("__r.r_before") + (F.col("__block") - F.col("__r.r_from")) * F.col("__r.r_live") + (F.lit(0) if turns is None else F.col("t_turn"))
    now = F.filter("p", lambda p: (p["p_from"] <= F.col("__at")) & (F.col("__at") < p["p_from"] + p["p_blocks"]))[0]
    j = F.col("__at") - F.col("__p.p_from")
    slot: Column = F.col("__p.p_slot") + F.floor(j / F.col("__p.p_quota")) * F.col("__p.p_total") + F.element_at("__p.p_at", (j % F.col("__p.p_quota") + 1).cast("int"))
    return (
        ranked.withColumn("__block", number)
        .join(F.broadcast(table), key.eqNullSafe(F.col("p_class")))
        .withColumn("__r", here)
        .withColumn("__at", at)
        .withColumn("__p", now)
        .select(*(F.col(f"`{c}`") for c in keep), F.col("__block").alias("block"), slot.cast("long").alias("slot"), (F.col("__rank") % block).cast("long").alias("place"))
    )


def mixed_order(docs: DataFrame, parts: dict[str, int], default: int = 1, **names: str) -> DataFrame:
    """The documents with their own columns, in partitions and rows by their place in the mix."""
    columns = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")
    keys = [F.col(f"`{names.get(k, v)}`").alias(v) for k, v in (("source_col", "source"), ("id_col", "doc_id"))]
    text = F.xxhash64(F.col(f"`{names.get('text_col', 'text')}`")).alias("text")
    return mix(docs.select(row, *keys, text), parts, default).orderBy("slot", "place").select("row.*")
