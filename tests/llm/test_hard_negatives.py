"""Hard negatives against a plain version."""

from __future__ import annotations

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tablewharf.llm import hard_negatives, queries

VECTORS = "vec_id long, embedding array<float>, label int, number string, score int"


def plain(rows, anchor, positives=5, negatives=10, low=30, high=90):
    good = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            good[(vec_id, tuple(math.floor(256 * x) for x in vector), label)] = None
    out = []
    for a, v, label in good:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, tag) for i, w, tag in good if len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits[:negatives])]
    return Counter(out)


def found(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("shard", [16_384, 7])
def test_random_vectors(spark, monkeypatch, shard):
    """Whole-number components make ties; many shards give the same rows; labels are uneven."""
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    rng = random.Random(2)
    rows = [(i * 3 - 90, [rng.randint(-3, 3) / 256 for _ in range(4)], rng.choice([0, 0, 0, 1, 2]), "n", 1) for i in range(120)]
    frame = spark.createDataFrame(rows, VECTORS)
    mined = hard_negatives.hard_negatives(frame, F.col("vec_id") % 2 == 0)
    assert found(mined) == plain(rows, lambda i: i % 2 == 0) != Counter()
    few = hard_negatives.hard_negatives(frame, F.col("vec_id") % 2 == 0, 2, 3, 0, 100)
    assert found(few) == plain(rows, lambda i: i % 2 == 0, 2, 3, 0, 100)


def test_odd_rows(spark):
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(i, v, 1, None, None) for i, v in enumerate(bad)] + [(None, [1.0, 1.0], 1, "x", 2), (6, [1.0, 1.0], None, "x", 2)]
    rows += [(10, [1.0, 1.0], 1, "a", 1)] * 2 + [(10, [1.0, 0.5], 1, "b", 1), (11, [1.0, 1.0], 1, "c", 1), (11, [0.5, 1.0], 2, "d", 1)]
    rows += [(12, [0.0, 0.0], 1, "z", 1), (13, [0.3, 0.4], 2, "e", 1), (14, [0.5, 0.2], 3, "e", 1), (15, [1.0, 1.0, 1.0], 1, "f", 1)]
    rows += [(20, [1.0, -1.0], 5, "g", 1), (21, [-1.0, 1.0], 5, "g", 1), (22, [1.0, 1.0], 6, "g", 1), (16, [0.5, 0.5, 0.5], 4, "f", 1)]
    frame = spark.createDataFrame(rows, VECTORS)
    everyone = hard_negatives.hard_negatives(frame, F.col("vec_id") >= 0)
    assert found(everyone) == plain(rows, lambda i: i >= 0) != Counter()
    assert hard_negatives.hard_negatives(frame, F.col("vec_id") > 99).isEmpty()
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("vec_id") >= 0).isEmpty()


def test_keys_sort_by_anchor_score_kind_and_id():
    rng = random.Random(9)
    rows = [(rng.randint(0, 3), rng.randint(-5, 5), rng.randint(-(1 << 53), 1 << 53), rng.randint(0, 1), rng.randint(-9, 9)) for _ in range(500)]
    packed = sorted(hard_negatives.packed_key(*r) for r in rows)
    assert [hard_negatives.unpacked_key(k) for k in packed] == sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))


def test_windows_stream():
    """One pass over sorted keys, never more than the open windows of one anchor."""
    def keys():
        for number in range(50):
            for score in range(1000, 0, -1):
                yield hard_negatives.packed_key(number, number, score, int(score % 10 > 0), score)

    rows = list(hard_negatives.mined(keys(), 2, 3, 30, 90))
    assert len(rows) == 50 * 2 * 3
    assert rows[:3] == [(0, 1000, 1, 899, 1000, 899), (0, 1000, 2, 898, 1000, 898), (0, 1000, 3, 897, 1000, 897)]


def test_op13(spark, small):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{small}/embeddings.parquet'").fetchall()
    shifted = [(i, v, (label + 1) % 10 if i % 7 == 0 and label is not None else label) for i, v, label in rows]
    assert found(queries.op13_hard_negatives(spark, small)) == plain(shifted, lambda i: i % 100 == 0)
