"""Importance resampling of documents towards a target distribution of hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.llm.common import store, with_prefix
from tablewharf.llm.run_hashes import run_hashes

BUCKETS = 10_000
GRAMS = 2
LEAST_WORDS = 20
SEED = 7
# The share of the documents that is drawn, as a fraction.
SHARE = (25, 100)
# Rows of a batch that are hashed at a time.
BATCH_ROWS = 500
# Entries of the quantile sketch, the first half-width of the bracket in ranks, and how it grows.
ACCURACY = 10_000
MARGIN = 2 / ACCURACY
WIDER = 8


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")


def bucket_counts(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all documents fall into each bucket; a task reports each bucket once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for texts, _ in _some(batches, "text"):
            for _, _, crc in run_hashes(texts, grams):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    found = docs.select(_text()).mapInArrow(counted, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _some(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(at, BATCH_ROWS)
            yield batch.column(column).to_pylist(), batch


def gains(source: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> list[int]:
    """For every bucket ``floor(1000 * ln(target share / source share))``, shares smoothed by one feature."""
    counts = []
    for docs in (source, target):
        at = {r["bucket"]: r["n"] for r in bucket_counts(docs, grams, buckets).collect()}
        counts.append([at.get(b, 0) for b in range(buckets)])
    s, t = counts
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((float(t[b] + 1) * all_s) / (float(s[b] + 1) * all_t))) for b in range(buckets)]


def scored(docs: DataFrame, gain: list[int], seed: int = SEED, grams: int = GRAMS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row.

    The gains are one array of constant size, in which every feature looks up its own.
    """
    array = np.array(gain, dtype=np.float64)  # whole numbers whose sums stay exact

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, batch in _some(batches, "text"):
            n_words, n_features, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for words, owner, crc in run_hashes(texts, grams):
                n_words += words
                n_features += np.bincount(owner, minlength=len(texts))
                sums = np.bincount(owner, weights=array[crc % np.uint32(len(array))], minlength=len(texts))
                total += sums.astype(np.int64)
            columns = [batch.column("doc_id"), *(pa.array(x) for x in (n_words, n_features, total))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "total"])

    rows = docs.select("doc_id", _text())
    sums = T.StructType().add("n_words", "long").add("n_features", "long").add("total", "long")
    rows = rows.mapInArrow(summed, T.StructType([rows.schema["doc_id"], *sums]))
    weight = F.expr("(total - pmod(total, n)) div n")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    n = F.greatest("n_features", F.lit(1).cast("bigint"))
    weighed = rows.withColumn("n", n).withColumn("weight", weight)
    return weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"))


def _order() -> list[Column]:
    """Highest score first, then the smaller id, null last; rows that still tie are equal in all that is returned."""
    doc_id = F.col("doc_id")
    return [-F.col("score"), doc_id.isNull(), doc_id, F.col("n_features"), F.col("n_words"), F.col("weight")]


def bracket(rows: DataFrame, k: int, total: int, margin: float = MARGIN) -> tuple[int, int, int]:
    """``low, high, above``: scores between which the kth highest lies, and how many rows are above.

    A mergeable quantile sketch proposes the bracket; exact counts of the rows outside confirm that the kth
    is inside, or the bracket is widened and counted again.
    """
    while True:
        if margin < 1:
            place = 1 - k / total
            ends = [max(0.0, place - margin), min(1.0, place + margin)]
            low, high = rows.agg(F.percentile_approx("score", ends, ACCURACY)).first()[0]
        else:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, below = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") < low)).first()
        if above < k <= total - below:
            return low, high, above
        margin = max(margin, MARGIN) * WIDER


def drawn(rows: DataFrame, k: int, total: int, margin: float = MARGIN) -> Column:
    """Whether a row is up to the kth in order (or equal to it).

    Only rows inside the bracket are sorted, in key ranges, to find the kth.
    """
    low, high, above = bracket(rows, k, total, margin)
    inside = with_prefix(rows.where(F.col("score").between(low, high)), _order(), [], "resample-bracket")
    last = inside.where(F.col("row_index") == k - above - 1).select(F.struct(*_order()).alias("last"))
    cut = last.first()["last"]
    kinds = [f.dataType for f in last.schema["last"].dataType.fields]
    return F.struct(*_order()) <= F.struct(*[F.lit(v).cast(kind) for v, kind in zip(cut, kinds)])


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    seed: int = SEED,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    margin: float = MARGIN,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``doc_id, text``; ``target`` has ``text``.

    Features are runs of 1 to ``grams`` words, hashed into buckets; a bucket's gain is the log ratio of its shares in
    target and documents; a document's weight is the floored mean gain. Its score adds Gumbel noise from a hash
    of seed and id, so the highest scores are a sample without replacement in proportion to the exponential
    of the weight. Of the documents with at least ``least_words`` words the share with the highest scores is drawn (rounded down) and
    ranked from 1; ties go to the smaller id; all others have rank null.

    Null, empty and wordless texts have no features and weight 0; texts of any length are read whole. A null id hashes as an
    empty one and ranks last among equal scores. Repeated rows are documents of their own. An empty table gives no rows, an
    empty target gains from counts of 0; other columns are ignored.

    Scores are stored once, in narrow rows. The cutoff comes from a sketch and exact counts; besides the bracket only the
    drawn rows are sorted, for their ranks, both in key ranges.
    """
    rows = store(scored(docs, gains(docs, target, grams, buckets), seed, grams), "resample-scores")
    candidates = rows.where(F.col("n_words") >= least_words)
    total = candidates.count()
    k = share[0] * total // share[1]
    columns = ["doc_id", "n_features", "weight", "score"]
    no_rank = F.lit(None).cast("bigint").alias("rank")
    if k == 0:
        return rows.select(*columns, no_rank)
    chosen = (F.col("n_words") >= least_words) & drawn(candidates, k, total, margin)
    ranked = with_prefix(rows.where(chosen), _order(), [], "resample-ranks")
    rank = F.when(F.col("row_index") < k, F.col("row_index") + 1).alias("rank")
    return ranked.select(*columns, rank).union(rows.where(~chosen).select(*columns, no_rank))
