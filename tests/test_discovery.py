"""Undeclared keys, fields of records and ranges for databases, against plain versions."""

from __future__ import annotations

import random
from functools import reduce
from itertools import combinations

import pytest
from pyspark.sql import DataFrame

from tablewharf.operators import keys
from tablewharf.sources import jdbc, records


def plain_keys(names, rows, most):
    found = []
    for n in range(1, most + 1):
        for some in combinations(range(len(names)), n):
            if any(set(k) <= set(some) for k in found):
                continue
            values = [tuple(r[i] for i in some) for r in rows]
            if rows and all(v is not None for t in values for v in t) and len(set(values)) == len(rows):
                found.append(some)
    return [tuple(names[i] for i in k) for k in found]


@pytest.mark.parametrize("seed", range(3))
def test_minimal_keys(spark, seed):
    rng = random.Random(seed)
    rows = [(i // 10, str(i % 10), rng.choice([1.5, 2.5, None]), rng.choice("ab"), rng.randint(0, 10**6) / 7) for i in range(300)]
    rows += [(100, "1", 0.0, "a", -1.0), (100, "2", -0.0, "a", -1.0)]
    frame = spark.createDataFrame(rows, "`a.b` int, s string, n double, c string, x double")
    assert keys.minimal_keys(frame, 3) == plain_keys(frame.columns, rows, 3)
    assert keys.minimal_keys(frame.limit(0)) == []
    assert keys.minimal_keys(frame.union(frame)) == []


def test_one_pass_for_each_level(spark, monkeypatch):
    frame = spark.range(1000).selectExpr("id % 10 AS a", "id div 10 % 10 AS b", "id div 100 AS c", "id % 2 AS d")
    passes, agg = [], type(frame).agg
    monkeypatch.setattr(type(frame), "agg", lambda self, *a: passes.append(len(a)) or agg(self, *a))
    assert keys.minimal_keys(frame, 3) == [("a", "b", "c")]
    assert len(passes) == 2  # columns; then only sets that can have enough values


@pytest.mark.parametrize("slice_rows", [40, 1 << 20])
def test_minimal_keys_of_large_tables(spark, monkeypatch, slice_rows):
    """Sets of one column, of two and of three, some spoilt by a single pair of rows outside or inside of a slice."""
    monkeypatch.setattr(keys, "SLICE_ROWS", slice_rows)
    rng = random.Random(5)
    rows = [(i // 10, str(i % 10), rng.choice([0.0, -0.0, 2.5]), rng.randint(0, 400), rng.randint(0, 10**9), i % 7) for i in range(1000)]
    for at in (3, 500, 800):
        rows.append((rows[at][0], rows[at][1], 9.5 + at, 1000 + at, rows[at][4], 8))
    rows.append((rows[7][0], "x", 0.0, 77, rows[8][4], 9))
    frame = spark.createDataFrame(rows, "`a.b` int, s string, n double, c int, x long, m int")
    expected = plain_keys(frame.columns, rows, 3)
    assert {len(k) for k in expected} >= {2, 3}
    assert keys.minimal_keys(frame, 3) == expected
    assert keys.minimal_keys(frame.union(frame.limit(1)), 3) == []


def test_few_sets_are_shuffled_as_whole_tables(spark, monkeypatch):
    """Rows are repeated for the hashes of few parts, not for each set that may be a key."""
    monkeypatch.setattr(keys, "SLICE_ROWS", 100)
    numbers = [f"pmod(xxhash64(id), {k}) AS c{k}" for k in range(2, 9)]
    frame = spark.range(5000).selectExpr("id div 2 AS a", "id % 2500 * 7 AS b", *numbers)
    bases, proven = [], keys._proven
    monkeypatch.setattr(keys, "_proven", lambda df, sets, parts: bases.append(len(set(parts))) or proven(df, sets, parts))
    assert keys.minimal_keys(frame, 3) == plain_keys(frame.columns, [tuple(r) for r in frame.collect()], 3)
    assert sum(bases) <= 12


def test_union_of_fields(spark):
    texts = ['{"a": 1, "b c": "x", "n": {"q": 1.5}, "z": null}', '{"a": 2, "late": true, "arr": [1]}', "bad", None, "[1]", "3"]
    texts += ['{"a": 3, "m": 1}', '{"m": "t", "big": 123456789012345678901, "VOID": 1, "e": {}}']
    frame = spark.createDataFrame([(t,) for t in texts], "r string")
    found = records.union_of_fields(frame, "r")
    kinds = {f.name: f.dataType.simpleString() for f in found.fields}
    assert kinds == {
        "a": "bigint", "b c": "string", "n": "struct<q:double>", "z": "string", "late": "boolean", "arr": "array<bigint>",
        "m": "string", "big": "decimal(21,0)", "VOID": "bigint", "e": "string",
    }
    rows = records.parse_records(frame, "r").where("m IS NOT NULL").select("m").collect()
    assert sorted(r.m for r in rows) == ["1", "t"]
    for nothing in (frame.limit(0), frame.where("r = 'bad'")):
        assert records.union_of_fields(nothing, "r").fields == []


def test_tuple_predicates_as_text():
    assert jdbc.tuple_predicates(["a"], []) == ["1 = 1"]
    assert jdbc.tuple_predicates(["a"], [(5,)]) == ["NOT (`a` IS NOT NULL AND ((`a` >= 5)))", "(`a` IS NOT NULL AND ((`a` >= 5)))"]
    (_, last) = jdbc.tuple_predicates(["a", "b"], [(1, "it's")], quote='"')
    assert last == """("a" IS NOT NULL AND "b" IS NOT NULL AND (("a" > 1) OR ("a" = 1 AND "b" >= 'it''s')))"""


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_every_row_is_in_one_range(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice([None, "a", "B", "é", "it's", ""]), rng.choice([None, 1, 2, 3]), i) for i in range(200)]
    frame = spark.createDataFrame(rows, "s string, n int, i int")
    for key in (["s", "n"], ["n", "i"], ["i"], ["s"]):
        clauses = jdbc.tuple_predicates(key, jdbc.key_starts(frame, key, ranges))
        parts = [frame.where(c) for c in clauses]
        whole = reduce(DataFrame.unionAll, parts)
        assert sorted(r.i for r in whole.collect()) == list(range(200))
    clauses = jdbc.tuple_predicates(["i"], jdbc.key_starts(frame, ["i"], ranges))
    assert len(clauses) == ranges and max(frame.where(c).count() for c in clauses) <= 2 * 200 / ranges + 1


def test_rows_with_variants_are_told_apart(spark):
    from tablewharf.operators import clean

    frame = spark.createDataFrame([(1, '{"a": 1}'), (1, '{"a":1}'), (1, '{"a": 2}'), (2, None), (2, None)], "k int, j string")
    frame = frame.selectExpr("k", "parse_json(j) AS v", "map('x', k) AS m")
    found = clean.distinct_rows(frame)
    assert found.schema["v"].dataType.typeName() == "variant"
    assert sorted((r.k, str(r.v), r.m["x"]) for r in found.selectExpr("k", "to_json(v) AS v", "m").collect()) == [
        (1, '{"a":1}', 1), (1, '{"a":2}', 1), (2, "None", 2),
    ]
    assert tuple(clean.duplicate_summary(frame).first()) == (5, 3, 2)


def test_bytes_and_late_years_as_text(spark):
    from tablewharf.operators import clean

    frame = spark.sql("SELECT X'C3BC' AS a, X'FF00' AS b, CAST(NULL AS BINARY) AS c, TIMESTAMP_NTZ '+12024-03-04 05:06:07.89' AS d")
    assert tuple(clean.text_table(frame).first()) == ("ü", "0xFF00", None, "+12024-03-04 05:06:07")
