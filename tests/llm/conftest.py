from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, row string, score int"
LONG = "".join(f"word{i} " for i in range(3000))


@pytest.fixture(scope="session")
def small():
    return os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and long texts, copies, ties, repeated rows; clashing names in the schema."""
    near = LONG.replace("word1500 ", "other ")
    texts = [None, "", "  \t\n", "a", "A", "Ein Haus <|endoftext|> und 'ne Maus's", "tick " * 400, "日本語 ünïcode 😀 ͸", LONG, LONG, near]
    rows = [
        (i, text, "xx" if i % 3 else None, f"s{i % 2}" if i % 4 else None, None, 1, "x", "y", 2) for i, text in enumerate(texts)
    ]
    return [*rows, rows[8], (None, "null id", None, None, None, None, None, None, None)]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)
