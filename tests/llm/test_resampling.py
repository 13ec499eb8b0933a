"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from tablewharf.llm import queries, resampling

WORDS = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def runs(text, grams):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, share=(25, 100), seed=7, grams=2, buckets=10_000, least=20):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    s = Counter(bucket(r) for _, text in docs for r in runs(text, grams)[1])
    t = Counter(bucket(r) for text in target for r in runs(text, grams)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows, order = [], []
    for place, (doc_id, text) in enumerate(docs):
        words, features = runs(text, grams)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(features), weight, score, None])
        if len(words) >= least:
            order.append((-score, doc_id is None, doc_id or 0, len(features), place))
    for rank, item in enumerate(sorted(order)[: share[0] * len(order) // share[1]]):
        rows[item[-1]][-1] = rank + 1
    return Counter(tuple(r) for r in rows)


def found(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_odd_rows(spark, odd, odd_rows):
    docs = [(r[0], r[1]) for r in odd_rows]
    goal = spark.createDataFrame([("Haus und word7 word8", 1), (None, 2), ("", 3)], "text string, doc_id int")
    target = ["Haus und word7 word8", None, ""]
    for options in ({}, {"least_words": 1, "share": (1, 2)}, {"grams": 3, "buckets": 50, "least_words": 0, "share": (1, 1)}):
        expected = plain(docs, target, **({k: v for k, v in options.items() if k != "least_words"} | {"least": options.get("least_words", 20)}))
        assert found(resampling.resample(odd, goal, **options)) == expected


def test_empty_tables(spark, odd, odd_rows, none):
    nothing = none.select("text")
    assert resampling.resample(none, nothing).isEmpty()
    assert found(resampling.resample(odd, nothing)) == plain([(r[0], r[1]) for r in odd_rows], [])


def test_ties_and_repeated_rows(spark):
    """A third of all rows are one row, and many scores are equal; the bracket holds them all and splits them."""
    docs = [(1, "a b c d")] * 300 + [(i % 150, "w x " * (1 + i % 2)) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([("a b",)], "text string")
    for share in ((1, 10), (1, 3), (9, 10)):
        result = resampling.resample(frame, goal, share=share, least_words=2, buckets=20)
        assert found(result) == plain(docs, ["a b"], share, least=2, buckets=20)
        ranks = sorted(r.rank for r in result.collect() if r.rank)
        assert ranks == list(range(1, share[0] * len(docs) // share[1] + 1))


@pytest.mark.parametrize("margin", [0.0, 1e-9, 0.3, 5.0])
def test_bracket_is_widened_until_it_holds(spark, margin):
    """Whatever the sketch says first, exact counts decide."""
    rows = spark.range(0, 5000).selectExpr("pmod(hash(id), 997) as score")
    scores = sorted((r.score for r in rows.collect()), reverse=True)
    for k in (1, 2, 1250, 4999, 5000):
        low, high, above = resampling.bracket(rows, k, 5000, margin)
        assert above == sum(s > high for s in scores) < k and low <= scores[k - 1] <= high


def test_wrong_sketches_are_noticed(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = spark.range(0, 1000).selectExpr("id as score")
    monkeypatch.setattr(resampling.F, "percentile_approx", lambda *a: F.array(F.lit(990), F.lit(995)))
    low, high, above = resampling.bracket(rows, 500, 1000)
    assert low <= 500 <= high and above == 999 - high


def test_op12(spark, small):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    target = [t for (t,) in duckdb.sql(f"SELECT text FROM '{small}/benchmark.parquet'").fetchall()]
    assert found(queries.op12_importance_resampling(spark, small)) == plain(docs, target)
