"""Every registered query gives the rows of its SQL twin."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from checks.data import TABLES

QUERIES, SQL = driver.queries(), driver.oracle_sql()

# Type names that mean the same in both engines.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "array<string>": "VARCHAR[]",
    "array<float>": "FLOAT[]",
}


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, data, duck, name):
    result = QUERIES[name](spark, data)
    columns = sorted(result.columns)
    expected = duck.sql(SQL[name])
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    for field in result.schema.fields:
        assert SAME_TYPE[field.dataType.simpleString()] == types[field.name], field.name
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in result.collect())
    order = [expected.columns.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in expected.fetchall())
    assert sum(ours.values()) == sum(theirs.values())
    assert ours == theirs
    assert theirs, "a check without rows proves nothing"
