"""Content reconciliation and split upserts on small frames."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewharf.operators import fingerprints, upsert

SCHEMA = "k int, name string, v double"


def spoiled(rng, rows):
    out, expected = [], {}
    for row in rows:
        kind = rng.choice([None] * 30 + ["lost", "changed", "doubled"])
        if kind == "changed":
            row = (row[0], row[1], -1.5)
        out += [row] * (0 if kind == "lost" else 2 if kind == "doubled" else 1)
        if kind:
            expected[str(row[0])] = (kind, 1, {"lost": 0, "changed": 1, "doubled": 2}[kind])
    out.append((5000, "new", 0.0))
    return out, expected | {"5000": ("surplus", 0, 1)}


@pytest.mark.parametrize("leaves,fan_out", [(1, 2), (7, 2), (64, 4), (1000, 16)])
@pytest.mark.parametrize("key", [["k"], ["k", "name"]])
def test_differences_are_found_by_any_tree(spark, leaves, fan_out, key):
    rng = random.Random(leaves)
    rows = [(k, rng.choice(["a", None, "b "]), rng.random()) for k in range(0, 600, 2)]
    copy, expected = spoiled(rng, rows)
    source, loaded = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(copy, SCHEMA)
    chunks, found = fingerprints.reconcile_content(source, loaded, key, leaves, fan_out)
    found = {r["k"]: (r["kind"], r["source_rows"], r["destination_rows"]) for r in found.collect()}
    assert found == expected
    assert all(r.source_rows <= 300 for r in chunks.collect())


def test_equal_tables_have_no_differences(spark):
    rows = [(k, str(k % 7), k / 3) for k in range(100)] + [(None, None, None), (3, "3", 1.0)] * 2
    source = spark.createDataFrame(rows, SCHEMA)
    loaded = spark.createDataFrame(rows[::-1], SCHEMA).select(*[F.col(c).cast("string").alias(c) for c in ("k", "name", "v")])
    for key in (["k"], ["name"]):
        chunks, found = fingerprints.reconcile_content(source, source.repartition(5), key)
        assert chunks.isEmpty() and found.isEmpty()
    assert fingerprints.reconcile_content(source.limit(0), loaded.limit(0), ["k"])[1].isEmpty()


def test_only_differing_nodes_are_looked_into(spark, monkeypatch):
    """One changed row among 4096 leaves: each level below the root keeps one node."""
    levels = []

    def stored(rows, purpose):
        kept = rows.cache()
        if purpose == "differing-nodes":
            levels.append(kept.count())
        return kept

    monkeypatch.setattr(fingerprints, "store", stored)
    source = spark.range(4096).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"), F.lit(1.0).alias("v"))
    loaded = source.withColumn("v", F.when(F.col("k") == 1234, 2.0).otherwise(F.col("v")))
    chunks, found = fingerprints.reconcile_content(source, loaded, ["k"])
    assert [tuple(r) for r in chunks.collect()] == [(1234, 1, 1)]
    assert [r["kind"] for r in found.collect()] == ["changed"]
    assert levels == [1, 1, 1, 1]


@pytest.mark.parametrize("bits", [1, 64, 40_000, upsert.BITMAP_BITS])
def test_split_upsert_equals_latest_per_key(spark, bits):
    rng = random.Random(bits)
    rows = [(rng.choice([None, *range(200)]), rng.choice(["a", None]), rng.random()) for _ in range(300)] + [(7, "hot", float(i)) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for key, order in ((["k"], ["v"]), (["k", "name"], [])):
        found = Counter(map(tuple, upsert.split_upsert(frame, key, order, bits).collect()))
        assert found == Counter(map(tuple, upsert.latest_per_key(frame, key, order).collect()))


def test_single_rows_are_not_shuffled(spark, data):
    """Only the bitmap reaches the rows, and a hot key still combines map-side."""
    lineitem = spark.read.parquet(f"{data}/lineitem.parquet")
    single, repeated = upsert.split_by_repetition(lineitem, ["l_orderkey", "l_linenumber"])
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange range" not in plan and "BroadcastExchange" in plan
    counts = lineitem.groupBy("l_orderkey", "l_linenumber").count()
    assert counts.where("count = 1").count() - single.count() < 0.01 * single.count()
    assert single.count() + repeated.count() == lineitem.count()
    winners = upsert.latest_per_key(repeated, ["l_orderkey", "l_linenumber"])
    assert "partial_max" in winners._jdf.queryExecution().executedPlan().toString()
