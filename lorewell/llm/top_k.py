"""Exact top-k inner products: a ball tree per shard, searched branch and bound.

Candidates are dealt to shards and queries to blocks, both of bounded size. A
shard's ball tree is built once and stored; a task holds one block and one shard's
tree. It goes down the tree from the root, the node with the
greatest upper bound ``<q, centre> + |q| * radius`` first, a whole block at a time: a node, with all
below it, is left out for the queries whose kth score so far its bound doesn't reach. Shards
are searched in rounds, each of twice as many shards as the one before, and
every round starts from the kth scores of all rounds before it.

Edge cases. Vectors that are null, empty, or hold null or non-finite components take no
part, nor do rows with a null id. Rows repeating an id count once, with the
smallest vector. Vectors of different lengths have no score with each other and don't
meet. Ties go to the smaller id. A query with fewer than k candidates gets all of
them; a table without candidates gives no rows. Extra columns are ignored.
Scores beyond a signed 64-bit integer are clamped to its range.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, forget, small_batches

#: Rows of a shard and queries of a block, at most on average.
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
LEAF = 64
#: Less than any score; its negative is an integer of 64 bits too.
NONE = -(2**63) + 1
RESULT = "query_id long, vec_id long, score long"


def integer_vector(c: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null if the vector takes no part."""
    x = c.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & (F.size(x) > 0)
    # floor of a double is a long; beyond its range the product itself is whole.
    return F.when(fine, F.transform(x, lambda v: F.when(F.abs(v * scale) < 2.0**53, F.floor(v * scale).cast("double")).otherwise(v * scale)))


class BallTree:
    """A ball tree over vectors x, by repeated halving along the widest spread.

    Node 0 is the root. A node has the rows from ``low`` to ``high`` (vectors and
    ids stand in the tree's order) and two children, or -1 for a leaf.
    """

    FIELDS = ("x", "ids", "low", "high", "left", "right", "centre", "radius")

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        order = np.arange(len(x))
        low, high, left, right = [0], [len(x)], [-1], [-1]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = low[node], high[node]
            if b - a <= leaf:
                continue
            part = x[order[a:b]]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], half)]
            left[node], right[node] = len(low), len(low) + 1
            low += [a, a + half]
            high += [a + half, b]
            left += [-1, -1]
            right += [-1, -1]
            todo += [left[node], right[node]]
        self.x, self.ids = x[order], ids[order]
        self.low, self.high, self.left, self.right = (np.array(v) for v in (low, high, left, right))
        self.centre = np.array([self.x[a:b].mean(0) for a, b in zip(low, high, strict=True)])
        self.radius = np.array([np.sqrt(((self.x[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(low, high, self.centre, strict=True)])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> BallTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(raw), allow_pickle=False) as found:
            for k in cls.FIELDS:
                setattr(tree, k, found[k])
        return tree

    def bounds(self, q: np.ndarray, norms: np.ndarray, node: int) -> np.ndarray:
        """No score of the node's rows is above these; some room for rounding."""
        bound = q @ self.centre[node] + norms * self.radius[node]
        return bound + np.abs(bound) * 1e-9 + 1e-6


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles if they all fit, else in Python's integers."""
    if len(q) and len(x) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**53:
        return (q @ x.T).astype(np.int64)
    big = np.array([[int(v) for v in r] for r in q], dtype=object).reshape(q.shape)
    other = np.array([[int(v) for v in r] for r in x], dtype=object).reshape(x.shape)
    return np.clip(big @ other.T, NONE + 1, 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best by (score descending, id ascending); worst entries have id of the largest integer."""
    if scores.shape[1] > k:
        # Keep all that tie with the kth, then order by both.
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        width = max(k, int((scores >= kth).sum(1).max()))
        if width < scores.shape[1]:
            at = np.argpartition(-scores, width - 1, axis=1)[:, :width]
            scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(q: np.ndarray, q_ids: np.ndarray, kth: np.ndarray, tree: BallTree, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best candidates of each query, without its own id, and the number of scores computed; kth: a score that a result must reach."""
    none, last = NONE, np.iinfo(np.int64).max
    scores, found = np.full((len(q), k), none), np.full((len(q), k), last)
    kth, computed = kth.copy(), 0
    norms = np.sqrt((q * q).sum(1))
    every = np.arange(len(q))
    first = tree.bounds(q, norms, 0)
    heap = [(-float(first.max()), 0, every, first)]
    while heap:
        _, node, alive, bound = heapq.heappop(heap)
        alive = alive[bound >= kth[alive]]  # scores may have risen since the node was found
        if not len(alive):
            continue
        if tree.left[node] >= 0:
            for child in (int(tree.left[node]), int(tree.right[node])):
                below = tree.bounds(q[alive], norms[alive], child)
                near = below >= kth[alive]
                if near.any():
                    heapq.heappush(heap, (-float(below[near].max()), child, alive[near], below[near]))
            continue
        rows = slice(tree.low[node], tree.high[node])
        s = exact_scores(q[alive], tree.x[rows])
        computed += s.size
        own = q_ids[alive][:, None] == tree.ids[rows][None, :]
        i = np.where(own, last, np.broadcast_to(tree.ids[rows], s.shape))
        s = np.where(own, none, s)
        hit = np.flatnonzero(s.max(1) >= kth[alive])
        if not len(hit):
            continue
        alive = alive[hit]
        best = _best(np.hstack([scores[alive], s[hit]]), np.hstack([found[alive], i[hit]]), k)
        scores[alive], found[alive] = best
        kth[alive] = np.maximum(kth[alive], best[0][:, -1])
    return scores, found, computed


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _plant(shard: pa.Table) -> pa.Table:
    """The vectors of one shard -> its tree, in one row."""
    dim, number = shard.column("dim")[0].as_py(), shard.column("shard")[0].as_py()
    tree = BallTree(_matrix(shard.column("vec"), dim), shard.column("vec_id").to_numpy())
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([number], pa.int32()), "tree": pa.array([tree.dump()], pa.binary())})


def _cell(k: int, left: pa.Table, right: pa.Table) -> pa.Table:
    names = ["query_id", "vec_id", "score"]
    empty = pa.table({n: pa.array([], pa.int64()) for n in names})
    if not left.num_rows or not right.num_rows:
        return empty
    dim = left.column("q_dim")[0].as_py()
    q_ids = left.column("query_id").to_numpy()
    kth = left.column("kth").to_numpy()
    scores, found, _ = search(_matrix(left.column("q_vec"), dim), q_ids, kth, BallTree.load(right.column("tree")[0].as_py()), k)
    real = found != np.iinfo(np.int64).max
    real &= scores >= kth[:, None]
    return pa.table({"query_id": np.repeat(q_ids, real.sum(1)), "vec_id": found[real], "score": scores[real]})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Each query's k best other rows: query_id, rank (from 1), vec_id, score.

    is_query: a condition on ``vec_id``. The work is queries times candidates, less
    what the bounds spare; what is shuffled is (queries * shards + candidates * blocks).
    """
    small_batches(vectors.sparkSession, 4096)
    rows = (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), integer_vector(F.col(f"`{vector_col}`"), scale).alias("vec"))
        .filter("vec_id is not null and vec is not null")
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
        .withColumn("dim", F.size("vec"))
    )
    rows = checkpointed(rows)
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_queries))
    place = lambda c, count, seed: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(count)).cast("int")
    trees = checkpointed(rows.withColumn("shard", place(F.col("vec_id"), shards, 1)).groupBy("dim", "shard").applyInArrow(_plant, "dim int, shard int, tree binary"))
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q_vec"), F.col("dim").alias("q_dim"), place(F.col("vec_id"), blocks, 2).alias("q_block"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())

    def met(known: DataFrame, first: int, last: int) -> DataFrame:
        """Every pair of a block and one of these shards is one group, so one task's work; known: queries with kth."""
        left = known.withColumn("q_shard", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
        right = trees.filter(F.col("shard").between(first, last - 1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy("q_dim", "q_shard", "q_block").cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(lambda a, b: _cell(k, a, b), RESULT)

    def best(found: DataFrame) -> DataFrame:
        # Spark keeps k rows of a query in each task before it shuffles them.
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    known, so_far, done, wave = queries.withColumn("kth", F.lit(NONE).cast("long")), None, 0, 1
    while True:
        last = min(shards, done + wave)
        found = met(known, done, last)
        found = found if so_far is None else so_far.unionByName(found)
        if last == shards:
            return best(found).select("query_id", "rank", "vec_id", "score")
        older, so_far = so_far, checkpointed(best(found).select("query_id", "vec_id", "score"))
        if older is not None:
            forget(older)
        # Only k scores make a bound; with fewer found, the query starts from nothing.
        bound = so_far.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("m")).filter(F.col("m") >= k).select("query_id", "low")
        known = queries.join(bound, "query_id", "left").withColumn("kth", F.coalesce("low", F.lit(NONE).cast("long"))).drop("low")
        done, wave = last, 2 * wave


def top_k_sql(step: int = 20, k: int = 20, scale: int = 64) -> str:
    """The query's rows by DuckDB, from the plain definition."""
    return f"""
        with v as (
            select vec_id, min(list_transform(embedding, lambda x: floor({scale} * x::double))) as vec from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
            group by vec_id),
        p as (
            select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.vec, c.vec) as bigint) as score
            from v q join v c on q.vec_id % {step} = 0 and c.vec_id <> q.vec_id and len(q.vec) = len(c.vec)),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= {k}
    """
