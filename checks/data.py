"""The driver tables, and deterministic dirt for them in Spark and in SQL.

The tables are spotless, so cleaning queries first spoil them by rules that
both engines evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions.text import WHITESPACE
from tablewharf.sources.files import read_table, read_tables

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Declared keys. The one of lineitem does not hold in the data.
KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "embeddings": ("vec_id",),
    "pages": ("page_id",),
    "benchmark": ("item_id",),
    "labels": ("doc_id",),
    "conversations": ("conv_id", "turn"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return read_tables(spark, folder, TABLES)


def sql_chars(text: str) -> str:
    return "||".join(f"chr({ord(c)})" for c in text)


SQL_WS = sql_chars(WHITESPACE)


def sql_trim(column: str) -> str:
    return f"trim({column}, {SQL_WS})"


def sql_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}" for t in TABLES
    )


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Padded priorities and sentinel statuses in orders."""
    key = F.col("o_orderkey")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(key % 13 == 0, "NaN")
        .when(key % 13 == 1, "NULL")
        .when(key % 13 == 2, "none")
        .when(key % 13 == 3, "-Inf")
        .when(key % 13 == 4, "nano")
        .otherwise(status)
        .alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(key % 7 == 0, F.concat(F.lit("\t"), priority, F.lit(" ")))
        .when(key % 7 == 1, F.concat(F.lit("\u3000"), priority, F.lit("\u00a0")))
        .otherwise(priority)
        .alias("o_orderpriority"),
    )


SQL_DIRTY_ORDERS = """
    SELECT o_orderkey, o_custkey,
           CASE o_orderkey % 13 WHEN 0 THEN 'NaN' WHEN 1 THEN 'NULL' WHEN 2 THEN 'none'
                WHEN 3 THEN '-Inf' WHEN 4 THEN 'nano' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate,
           CASE o_orderkey % 7 WHEN 0 THEN chr(9) || o_orderpriority || chr(32)
                WHEN 1 THEN chr(12288) || o_orderpriority || chr(160)
                ELSE o_orderpriority END AS o_orderpriority
    FROM orders
"""


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """NULL, NaN and infinite values in events."""
    key = F.col("event_id")
    return table(spark, folder, "events").withColumn(
        "value",
        F.when(key % 11 == 0, None)
        .when(key % 11 == 1, float("nan"))
        .when(key % 11 == 2, float("inf"))
        .when(key % 11 == 3, float("-inf"))
        .otherwise(F.col("value")),
    )


SQL_DIRTY_EVENTS = """
    SELECT event_id, ts, user_id, event_type,
           CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
                WHEN 3 THEN '-inf'::DOUBLE ELSE value END AS value, props
    FROM events
"""
