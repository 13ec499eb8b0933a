"""Random dirty tables through the whole copy, against a plain Python model."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from tablewharf.functions.text import SENTINELS, WHITESPACE
from tablewharf.plans.table_job import TableJob, run_table
from tablewharf.sinks.workspace import new_folder

LIMIT = 12


def random_rows(seed, n):
    rng = random.Random(seed)
    texts = [None, "", "a", "A", " a", "a\t", "　é", "é ", "NaN", "null", " none ", "漢" * 5, "x" * 13, "​a"]
    keys = ["k1", "k1 ", "K1", "k2", "k2", "k2", None, "NULL", "-inf", "long key text", ""]
    floats = [None, 0.0, -0.0, 1.5, 1e7, 1e-5, math.nan, math.inf, -math.inf]
    return [
        (rng.choice(keys), rng.choice([None, 0, 1, 2]), rng.choice(texts), rng.choice(floats)) for _ in range(n)
    ]


def same(value):
    """One object for values that count as equal when rows are compared."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def cleaned(row):
    k, o, s, f = row
    return (
        None if k is None else k.strip(WHITESPACE),
        0 if o is None else o,
        None if s is None else s.strip(WHITESPACE),
        0.0 if f is None or math.isnan(f) or math.isinf(f) else f + 0.0,
    )


def text(row):
    def one(value):
        if isinstance(value, str):
            return None if value.lower() in SENTINELS else value
        if isinstance(value, float):
            return {1e7: "10000000.0", 1e-5: "0.00001"}.get(value, str(value))
        return None if value is None else str(value)

    return tuple(map(one, row))


def refused(row, keyed):
    k, _, s, _ = text(row)
    if keyed:
        if k is None or len(k) > LIMIT:
            return True
    elif k is not None and len(k.encode()) > LIMIT:
        return True
    return s is not None and len(s.encode()) > LIMIT


def rank(row):
    k, o, s, f = row
    return (o, k, (s is not None, s or ""), f)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("keyed", [False, True])
def test_copy_matches_the_model(spark, seed, keyed):
    rows = random_rows(seed, 150)
    df = spark.createDataFrame(rows, "k string, o int, s string, f double").repartition(seed + 2)
    limits = {"max_text_bytes": LIMIT, "max_key_chars": LIMIT}
    job = TableJob("t", df, ("k",) if keyed else (), ("o",), count_duplicates=True, limits=limits)
    result = run_table(job, new_folder(spark, "model"))

    distinct = {tuple(map(same, r)): r for r in rows}.values()
    clean_rows = [cleaned(r) for r in distinct]
    good = [r for r in clean_rows if not refused(r, keyed)]
    if keyed:
        winners = {}
        for r in good:
            if r[0] not in winners or rank(r) > rank(winners[r[0]]):
                winners[r[0]] = r
        expected = list(winners.values())
    else:
        expected = good
    loaded = Counter(map(tuple, spark.read.parquet(result.location).collect()))
    assert loaded == Counter(map(text, expected))
    assert result.duplicates == len(rows) - len(distinct)
    assert result.quarantined == len(clean_rows) - len(good)
    assert result.superseded == len(good) - len(expected)
    assert result.dst_rows == len(expected)
    nulls = {c: sum(r[i] is None for r in expected) for i, c in enumerate("kosf")}
    assert result.nulls == {c: n for c, n in nulls.items() if n}
