"""Greedy batches against a plain loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablewharf.operators.batches import byte_size, with_bounded_batches


def plain(rows, limit):
    """Batch numbers of (group, key, size) rows in order."""
    out, now, held, batch = {}, None, 0, -1
    for group, key, size in sorted(rows):
        if batch < 0 or group != now or held + size > limit:
            batch, held, now = batch + 1, 0, group
        held += size
        out[key] = batch
    return out


@pytest.mark.parametrize("range_rows", [3, 7, 1000])
@pytest.mark.parametrize("grouped", [False, True])
def test_random_sizes(spark, range_rows, grouped):
    rng = random.Random(range_rows)
    for sizes, limit in (([0, 1, 2, 9, 30], 10), ([0], 5), ([1], 4), ([0, 0, 0, 11], 10), ([3, 4, 5], 1000), ([5], 5)):
        groups = [0] if not grouped else [1, 2, 2, 2, 3]
        rows = [(rng.choice(groups), key, rng.choice(sizes)) for key in rng.sample(range(1000), 60)]
        rows = [(0 if not grouped else g, k, s) for g, k, s in rows]
        frame = spark.createDataFrame(rows, "g int, k int, s int").repartition(4)
        group = ["g"] if grouped else []
        found = with_bounded_batches(frame, F.col("s"), "k", limit, group, range_rows=range_rows).collect()
        assert {r.k: r.batch_id for r in found} == plain(rows, limit)
        assert len(found) == len(rows)


def test_limit_is_kept_where_running_totals_break_it(spark):
    """Two rows of nine bytes never share a batch of ten."""
    frame = spark.createDataFrame([(1, "123456789"), (2, "123456789"), (3, "1"), (4, None), (5, "ü" * 20)], "k int, t string")
    found = {r.k: r.batch_id for r in with_bounded_batches(frame, byte_size(["t"]), "k", 10).collect()}
    assert found == {1: 0, 2: 1, 3: 1, 4: 1, 5: 2}


def test_empty_and_clashing_names(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4, 5)], "batch_id int, row_index int, part int, opens int, `a b` int")
    assert with_bounded_batches(frame.limit(0), F.lit(1), "batch_id", 3, name="n").isEmpty()
    found = with_bounded_batches(frame, F.lit(1), "a b", 3, ["part"], name="n").first()
    assert found.asDict() == {"batch_id": 1, "row_index": 2, "part": 3, "opens": 4, "a b": 5, "n": 0}
