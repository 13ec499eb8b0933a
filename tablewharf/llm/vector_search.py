"""Exact top-k search by inner product with one KD-tree per shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewharf.llm.common import store
from tablewharf.llm.shards import matrix, meet, table_of

TOP = 5
# Vectors in a shard, which one task holds, and queries that search it at a time.
SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
LEAF = 256
SCALE = 256
LONG = (-(1 << 63), (1 << 63) - 1)


class KdTree:
    """Median splits along the widest side, with tight bounding boxes, stored level by level."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self.nodes: list[tuple[int, int, int, int]] = []  # first, end, left, right
        low, high = [], []
        places = np.arange(len(points))
        waiting = [(0, len(points), -1, 0)]
        while waiting:
            first, end, parent, side = waiting.pop()
            node = len(self.nodes)
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, node, right) if side == 0 else (a, b, left, node)
            part = self.points[places[first:end]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            self.nodes.append((first, end, -1, -1))
            spread = high[-1] - low[-1]
            if end - first > leaf and spread.max() > 0:
                middle = (end - first) // 2
                split = np.argpartition(part[:, int(np.argmax(spread))], middle)
                places[first:end] = places[first:end][split]
                waiting += [(first + middle, end, node, 1), (first, first + middle, node, 0)]
        self.points, self.ids = self.points[places], self.ids[places]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product that each query can have in each box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, top: int) -> list[list[tuple[int, int]]]:
        """For each query its best ``(score, id)``, at most ``top``, none below its floor.

        Best-first: a query opens boxes in the order of their bounds and stops when the next bound is
        below its kth score. Queries that open the same leaf are multiplied together, in rounds.
        """
        bounds = self.bounds(queries)
        fronts = [[(-bounds[q, 0], 0)] for q in range(len(queries))]
        best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]  # heaps of (score, -id)
        open_queries = list(range(len(queries)))
        while open_queries:
            visits: dict[int, list[int]] = {}
            for q in open_queries:
                front, limit = fronts[q], self._limit(best[q], floor[q], top)
                while front:
                    bound, node = heapq.heappop(front)
                    if -bound < limit:
                        front.clear()
                        break
                    _, _, left, right = self.nodes[node]
                    if left < 0:
                        visits.setdefault(node, []).append(q)
                        break
                    for child in (left, right):
                        if bounds[q, child] >= limit:
                            heapq.heappush(front, (-bounds[q, child], child))
            for node, group in visits.items():
                first, end, _, _ = self.nodes[node]
                ids = self.ids[first:end]
                scores = queries[group] @ self.points[first:end].T
                scores[ids[None, :] == own[group][:, None]] = -np.inf
                for q, row in zip(group, scores):
                    self._offer(best[q], row, ids, self._limit(best[q], floor[q], top), top)
            open_queries = [q for group in visits.values() for q in group if fronts[q]]
        return [sorted(((s, -i) for s, i in heap), key=lambda x: (-x[0], x[1])) for heap in best]

    @staticmethod
    def _limit(heap: list[tuple[int, int]], floor: float, top: int) -> float:
        return max(floor, heap[0][0]) if len(heap) == top else floor

    @staticmethod
    def _offer(heap: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, limit: float, top: int) -> None:
        good = np.flatnonzero((scores >= limit) & (scores > -np.inf))
        if len(good) > top:
            good = good[np.lexsort((ids[good], -scores[good]))[:top]]
        for k in good:
            item = (int(scores[k]), -int(ids[k]))
            if len(heap) < top:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def whole_components(vector: Column) -> Column:
    """``floor(SCALE * x)`` for each component, as whole numbers in doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))


def top_k(vectors: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's ``top`` best other vectors.

    Components become ``floor(256 * x)`` and scores are exact integer inner products; ties go
    to the smaller id. All vectors are dealt into shards by a hash of the id, each with a KD-tree, once; queries
    come by in batches. In a first round each query visits one shard; its kth score there is the floor with
    which the second round prunes the other shards.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do null ids.
    Vectors compare only with those of the same length. Rows that repeat an id and vector count once; of rows that
    repeat an id with other vectors each is a candidate, and each is a query, merged under its id. Fewer candidates
    give fewer ranks; an empty table gives no rows; other columns are ignored. Scores
    up to 2**53 are exact.
    """
    vector = F.col("embedding")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(vector))
    rows = rows.select("vec_id", whole_components(vector).alias("v"), is_query.alias("q")).distinct()
    rows = store(rows.withColumn("dim", F.size("v")), "search-rows")
    count = rows.count()
    shards = max(1, -(-count // SHARD_ROWS))
    salted = F.xxhash64("vec_id", F.lit(7))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = rows.where("q").withColumn("home", F.pmod(salted, F.lit(shards)).cast("int"))

    candidates = dealt.select("dim", "shard", "vec_id", "v")
    first = asked.select("dim", F.col("home").alias("shard"), "vec_id", "v", F.lit(float("-inf")).alias("floor"))
    near = store(_searched(candidates, first, shards, top), "search-first")
    if shards == 1:
        return _ranked(near, top)
    kth = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    floor = F.when(F.col("n") >= top, F.col("kth").cast("double")).otherwise(float("-inf"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    again = asked.join(kth.select("vec_id", floor.alias("floor")), "vec_id", "left")
    again = again.select("dim", every, "home", "vec_id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    far = _searched(candidates, again.where("shard <> home").drop("home"), shards, top)
    return _ranked(near.union(far), top)


def _searched(candidates: DataFrame, asked: DataFrame, shards: int, top: int) -> DataFrame:
    """``query_id, vec_id, score`` of the best that each query finds in the shards it visits; each shard builds its tree once."""
    names, kinds = ["query_id", "vec_id", "score"], [pa.int64()] * 3

    def hold(table: pa.Table, dim: int) -> KdTree:
        return KdTree(matrix(table.column("v"), dim), table.column("vec_id").to_numpy())

    def ask(tree: KdTree, batch: pa.RecordBatch, dim: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            own = some.column("vec_id").to_numpy()
            hits = tree.search(matrix(some.column("v"), dim), own, some.column("floor").to_numpy(), top)
            yield table_of([(q, i, s) for q, found in zip(own.tolist(), hits) for s, i in found], names, kinds)

    return meet(candidates, asked, shards, hold, ask, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of each query; a query has at most ``top`` rows from each shard."""
    best = found.distinct().groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, top).alias("best")
    )
    hit = best.select("query_id", F.posexplode("best").alias("place", "hit"))
    rank = (F.col("place") + 1).cast("int").alias("rank")
    return hit.select("query_id", rank, F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
