"""Hard negatives for anchors, by a secondary sort of scored pairs."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.llm.common import store
from tablewharf.llm.shards import matrix, meet, table_of
from tablewharf.llm.vector_search import usable, whole_components

POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these percentages of its positive's score.
LOW, HIGH = 30, 90
# Candidates of a shard, which one task holds as a matrix, and anchors that meet it at a time.
SHARD_ROWS = 16_384
ANCHOR_ROWS = 256
# Anchors and pairs that one task of the sort takes, about.
SORT_ANCHORS = 2_048

# A key: number of the anchor, its id, descending score, 0 for positives and 1 for negatives, id of the other row.
KEY = struct.Struct(">QQQBQ")
BIAS = 1 << 63
Answer = Callable[["Shard", np.ndarray, pa.RecordBatch], Iterator[tuple]]
POSITIVE, NEGATIVE = 0, 1


def packed_key(number: int, anchor: int, score: int, kind: int, other: int) -> bytes:
    """Bytes that sort by anchor, then descending score, then positives first, then id."""
    return KEY.pack(number, anchor + BIAS, BIAS - score, kind, other + BIAS)


def unpacked_key(key: bytes) -> tuple[int, int, int, int, int]:
    number, anchor, score, kind, other = KEY.unpack(key)
    return number, anchor - BIAS, BIAS - score, kind, other - BIAS


def mined(keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from sorted keys.

    A positive opens a window, and each negative goes to all open windows that its score fits; a window closes when it is
    full or when scores have fallen below it. Only the open windows of one anchor are held.
    """
    now, seen, windows = None, 0, []
    for key in keys:
        number, anchor, score, kind, other = unpacked_key(key)
        if number != now:
            now, seen, windows = number, 0, []
        if kind == POSITIVE:
            seen += 1
            if seen <= positives:
                windows.append([score, other, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[0]]
        for window in windows:
            if 100 * score <= high * window[0]:
                window[2] += 1
                yield anchor, window[1], window[2], other, window[0], score


class Shard:
    """Candidates of one shard, ordered by label and id, with exact whole-number scores."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: list) -> None:
        names = {label: n for n, label in enumerate(sorted(set(labels), key=repr))}
        codes = np.array([names[label] for label in labels])
        order = np.lexsort((ids, codes))
        self.vectors, self.ids = vectors[order], ids[order]
        cuts = np.searchsorted(codes[order], np.arange(len(names) + 1))
        self.spans = {label: (int(cuts[n]), int(cuts[n + 1])) for label, n in names.items()}

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.vectors.T

    def positives(self, scores: np.ndarray, label: object, own: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best other rows of a label."""
        first, end = self.spans.get(label, (0, 0))
        ids, scores = self.ids[first:end], scores[first:end]
        places = self._best(np.where(ids == own, -np.inf, scores), ids, top)
        places = places[ids[places] != own]
        return scores[places], ids[places]

    def negatives(self, scores: np.ndarray, label: object, windows: list[tuple[int, int]], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of rows of other labels that are among the best of some window in this shard."""
        first, end = self.spans.get(label, (0, 0))
        wanted = []
        for low, high in windows:
            fits = (scores >= low) & (scores <= high)
            fits[first:end] = False
            fits = np.flatnonzero(fits)
            wanted.append(fits[self._best(scores[fits], self.ids[fits], top)])
        places = np.unique(np.concatenate(wanted)) if wanted else np.empty(0, dtype=np.int64)
        return scores[places], self.ids[places]

    @staticmethod
    def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
        """Places of the best scores, ties to the smaller id."""
        places = np.arange(len(scores))
        if len(scores) > top:
            kth = np.partition(scores, len(scores) - top)[len(scores) - top]
            places = np.flatnonzero(scores >= kth)
        return places[np.lexsort((ids[places], -scores[places]))[:top]]


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, embedding, label``.

    Components become ``floor(256 * x)`` and scores are whole inner products, exact up to 2**53. An anchor's positives are its best
    ``positives`` other rows of the same label; each gets the best ``negatives`` rows of other labels whose score lies
    from ``low`` to ``high`` percent of the positive's. Ties go to the smaller id.

    Rows with a null id, label or vector, an empty one, or null or non-finite components take no part;
    vectors meet only those of the same length. Equal rows count once. Rows that repeat an id with another vector or label are
    rows of their own, each an anchor if the id is one, and a positive has another id than its anchor. Without a positive, or a negative
    that fits, an anchor has no rows; an empty table gives none; other columns are ignored.

    Candidates are dealt once into shards of bounded size, and anchors come by in batches. A first pass finds the
    positives: each shard offers an anchor its own best, and these combine. A second pass packs into keys the negatives that
    are among the best of a window in their shard, which drops none that could be returned. The keys of positives and negatives meet in
    ``repartitionAndSortWithinPartitions``, which spills, and an iterator reads them in order. Labels and anchors
    of any size spread over the shards.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    rows = rows.select("vec_id", whole_components(F.col("embedding")).alias("v"), "label", is_anchor.alias("a")).distinct()
    rows = store(rows.withColumns({"number": F.monotonically_increasing_id(), "dim": F.size("v")}), "mining-rows")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    anchors = rows.where("a")

    found = _meet(rows, anchors, shards, _positives_in(positives), ["number", "id", "score", "other"], [pa.int64()] * 4)
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "other"))
    first = found.withColumn("place", place).where(F.col("place") <= positives)  # Spark cuts to the best before the shuffle, too
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("other").alias("p"))))
    known = store(first.groupBy("number", "id").agg(best.alias("best")), "mining-positives")
    windows = known.select("number", F.transform("best", lambda b: -b["s"]).alias("scores"))
    with_windows = anchors.join(windows, "number")
    others = _meet(rows, with_windows, shards, _negatives_in(negatives, low, high), ["key"], [pa.binary()])

    sort_tasks = max(1, -(-anchors.count() // SORT_ANCHORS), shards)
    opening = known.rdd.flatMap(lambda r: [packed_key(r["number"], r["id"], -b["s"], POSITIVE, b["p"]) for b in r["best"]])
    pairs = opening.union(others.rdd.map(lambda r: bytes(r["key"]))).map(lambda key: (key, None))
    ordered = pairs.repartitionAndSortWithinPartitions(sort_tasks, lambda key: zlib.crc32(key[:8]))
    mining = ordered.mapPartitions(lambda part: mined((key for key, _ in part), positives, negatives, low, high))
    names = [("anchor_id", T.LongType()), ("positive_id", T.LongType()), ("rank", T.IntegerType()), ("negative_id", T.LongType()),
             ("positive_score", T.LongType()), ("negative_score", T.LongType())]
    return rows.sparkSession.createDataFrame(mining, T.StructType([T.StructField(n, t) for n, t in names]))


def _meet(rows: DataFrame, anchors: DataFrame, shards: int, answer: Answer, names: list[str], kinds: list[pa.DataType]) -> DataFrame:
    """Every anchor meets every shard of its dimension: ``answer(shard, scores of some anchors, these anchors)``."""

    def hold(table: pa.Table, dim: int) -> Shard:
        return Shard(matrix(table.column("v"), dim), table.column("vec_id").to_numpy(), table.column("label").to_pylist())

    def ask(shard: Shard, batch: pa.RecordBatch, dim: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, ANCHOR_ROWS):
            some = batch.slice(at, ANCHOR_ROWS)
            yield table_of(list(answer(shard, shard.scores(matrix(some.column("v"), dim)), some)), names, kinds)

    dealt = F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int").alias("shard")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    columns = ["dim", "number", "vec_id", "v", "label"]
    asking = anchors.select(every, *columns, *[c for c in anchors.columns if c == "scores"])
    schema = ", ".join(f"{n} {'binary' if k == pa.binary() else 'long'}" for n, k in zip(names, kinds))
    return meet(rows.select(dealt, *columns), asking, shards, hold, ask, schema)


def _positives_in(top: int) -> Answer:
    def ask(shard: Shard, scores: np.ndarray, anchors: pa.RecordBatch) -> Iterator[tuple]:
        columns = (anchors.column(c).to_pylist() for c in ("number", "vec_id", "label"))
        for row, number, own, label in zip(scores, *columns):
            for score, other in zip(*shard.positives(row, label, own, top)):
                yield number, own, int(score), int(other)

    return ask


def _negatives_in(top: int, low: int, high: int) -> Answer:
    def ask(shard: Shard, scores: np.ndarray, anchors: pa.RecordBatch) -> Iterator[tuple]:
        columns = (anchors.column(c).to_pylist() for c in ("number", "vec_id", "label", "scores"))
        for row, number, own, label, known in zip(scores, *columns):
            windows = {(-(-low * s // 100), high * s // 100) for s in known}
            for score, other in zip(*shard.negatives(row, label, [w for w in windows if w[0] <= w[1]], top)):
                yield (packed_key(number, own, int(score), NEGATIVE, int(other)),)

    return ask
