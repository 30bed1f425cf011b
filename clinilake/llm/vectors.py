"""Exact top-k search by inner product: KD-trees per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash of their id.
A task builds its shard's tree: median splits along the widest side, each node
with the tight bounding box of its points.  A query goes through a tree best
first, by the greatest inner product that a box allows, and stops when no open
box can reach the kth best score so far.

That kth score is propagated: each query first searches one home shard, and
enters all others with the score it has already got k rows for.

Queries come in blocks of ``BLOCK_QUERIES``; a task holds one shard and one
block.  Results of a shard are k rows a query at most; a ranking window whose
partial limit runs before the shuffle merges them.

Scores are exact integers: components become floor(1024 * x), and sums run in
double precision only where all of them stay below 2**53, else in Python's
integers (a score beyond a long ends at its limit).

Defined results: null vectors, vectors with a null or non-finite component and
rows without an id take no part; shorter vectors count as filled up with zeros;
of rows that repeat a query's id the smallest vector asks, and all of them are
candidates for other queries only; equal scores go by the smaller id; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 1024
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 64
_LIMIT = (1 << 63) - 1

FOUND = "query_id long, vec_id long, score long"


class Tree:
    """A KD-tree over the rows of a matrix, with tight boxes."""

    def __init__(self, points: np.ndarray) -> None:
        order = np.arange(len(points))
        self.low, self.high, self.nodes = [], [], []
        # Each node: (first row, end, left child, right child); children 0 for a leaf.
        todo = [(0, len(points), None, 0)]
        while todo:
            first, end, parent, side = todo.pop()
            own = points[order[first:end]]
            low, high = own.min(axis=0), own.max(axis=0)
            here = len(self.nodes)
            self.low.append(low)
            self.high.append(high)
            self.nodes.append([first, end, 0, 0])
            if parent is not None:
                self.nodes[parent][2 + side] = here
            if end - first > LEAF_ROWS:
                middle = (end - first) // 2
                split = np.argpartition(own[:, int(np.argmax(high - low))], middle)
                order[first:end] = order[first:end][split]
                todo += [(first + middle, end, here, 1), (first, first + middle, here, 0)]
        self.order, self.points = order, points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product each box allows: queries x nodes."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, ids: np.ndarray, own_id: int, k: int,
               kth) -> list[tuple]:
        """The k best (score, -id), none below ``kth``, without ``own_id``."""
        best: list[tuple] = []  # a heap, the worst first
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if kth is not None and -bound < kth:
                break
            first, end, left, right = self.nodes[node]
            if left:
                for child in (left, right):
                    if kth is None or bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            scores = self.points[first:end] @ query
            if scores.dtype == object:
                scores = np.clip(scores, -_LIMIT - 1, _LIMIT)
            near = np.arange(end - first) if kth is None else np.flatnonzero(scores >= kth)
            for r in near:
                vec = int(ids[self.order[first + r]])
                if vec != own_id:
                    entry = (int(scores[r]), -vec)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            if len(best) == k:
                kth = best[0][0] if kth is None else max(kth, best[0][0])
        return best


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integer lists, filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for k, row in enumerate(column.to_pylist()):
        out[k, :len(row)] = row
    return out


def _searching(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if vectors.num_rows and queries.num_rows:
            width = max(1, *(len(x) for t in (vectors, queries) for x in t.column("v")))
            points, asks = _matrix(vectors.column("v"), width), _matrix(queries.column("v"), width)
            sizes = [max(abs(int(m.max())), abs(int(m.min()))) for m in (points, asks)]
            kind = np.float64 if sizes[0] * sizes[1] * width < 1 << 53 else object
            points, asks = points.astype(kind), asks.astype(kind)
            ids = vectors.column("vec_id").to_numpy()
            tree = Tree(points)
            for first in range(0, len(asks), 256):
                bounds = tree.bounds(asks[first:first + 256])
                part = queries.slice(first, 256)
                for q, b, own, kth in zip(asks[first:first + 256], bounds, part.column("query_id").to_pylist(),
                                          part.column("kth").to_pylist(), strict=True):
                    out += [(own, -v, s) for s, v in tree.search(q, b, ids, own, k, kth)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])
    return run


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): the rows that take part, components as floor(1024 * x)."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")).alias("v"))


def top_k(embeddings: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """The k best rows for each row of ``embeddings`` where ``asks`` (on vec_id) holds.

    query_id, rank (from 1), vec_id, score.
    """
    vectors = integers(embeddings)
    queries = (vectors.where(asks).groupBy("vec_id").agg(F.min("v").alias("v"))
               .select(F.col("vec_id").alias("query_id"), "v"))
    n = vectors.count()
    shards = max(1, -(-n // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    home = F.pmod(F.xxhash64(F.col("query_id")), F.lit(shards))
    run = _searching(k)

    first = stored(
        dealt.groupBy("shard")
        .cogroup(queries.withColumn("shard", home).withColumn("kth", F.lit(None).cast("long")).groupBy("shard"))
        .applyInArrow(run, FOUND), "home_shard")
    # The kth score, where the home shard had k rows.
    known = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).select(
        "query_id", F.when(F.col("n") >= k, F.col("low")).alias("kth"))
    open_queries = queries.join(known, "query_id", "left").select(
        "*", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")),
                                lambda s: s != home)).alias("shard"),
        F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).alias("block"))
    spread = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    rest = (spread.groupBy("shard", "block").cogroup(open_queries.groupBy("shard", "block"))
            .applyInArrow(run, FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
