"""Cleaning of values and recovery of types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.data import (
    SQL_DIRTY_EVENTS,
    SQL_DIRTY_ORDERS,
    dirty_events,
    dirty_orders,
    sql_trim,
    table,
)
from tablewharf.operators import clean, infer, quality


@check("SELECT DISTINCT quality, toxic FROM labels")
def d1_distinct_labels(spark, folder):
    return clean.distinct_rows(table(spark, folder, "labels").drop("doc_id"))


@check("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def d1_distinct_documents(spark, folder):
    return clean.distinct_rows(table(spark, folder, "documents").drop("doc_id"))


@check("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def d1_distinct_copied_table(spark, folder):
    lines = table(spark, folder, "lineitem")
    return clean.distinct_rows(lines.unionByName(lines))


_FIRST = {
    "labels": "doc_id",
    "documents": "doc_id",
    "events": "event_id",
    "lineitem": "l_orderkey",
    "conversations": "conv_id",
    "pages": "page_id",
}


@check(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_in, count(*) AS rows_out,"
        f" (SELECT count(*) FROM {t}) - count(*) AS removed"
        f" FROM (SELECT DISTINCT * EXCLUDE ({c}) FROM {t})"
        for t, c in _FIRST.items()
    )
)
def d1_removed_counts(spark, folder):
    """How many rows of each table differ from another one only in the first column."""
    summaries = [
        clean.duplicate_summary(table(spark, folder, t).drop(c)).select(
            F.lit(t).alias("table_name"), "*"
        )
        for t, c in _FIRST.items()
    ]
    return reduce(DataFrame.unionByName, summaries)


_SQL_PADDED = (
    "SELECT * FROM orders UNION ALL SELECT * REPLACE (o_orderpriority || ' ' AS o_orderpriority)"
    " FROM orders UNION ALL SELECT * FROM orders"
)


@check(
    f"SELECT * REPLACE ({sql_trim('o_orderstatus')} AS o_orderstatus, {sql_trim('o_orderpriority')}"
    f" AS o_orderpriority) FROM (SELECT DISTINCT * FROM ({_SQL_PADDED}))"
)
def d1_distinct_before_trim(spark, folder):
    """Copies that differ by padding both stay: distinct runs before trim."""
    orders = table(spark, folder, "orders")
    padded = orders.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit(" ")))
    return clean.trim_strings(clean.distinct_rows(orders.unionByName(padded).unionByName(orders)))


@check(
    f"SELECT * REPLACE ({sql_trim('o_orderstatus')} AS o_orderstatus, {sql_trim('o_orderpriority')}"
    f" AS o_orderpriority) FROM ({SQL_DIRTY_ORDERS})"
)
def d2_trim(spark, folder):
    return clean.trim_strings(dirty_orders(spark, folder))


@check(
    f"SELECT * REPLACE ({sql_trim('text')} AS text, {sql_trim('lang')} AS lang,"
    f" {sql_trim('source')} AS source) FROM documents"
)
def d2_trim_documents(spark, folder):
    return clean.trim_strings(table(spark, folder, "documents"))


@check(f"SELECT * REPLACE (coalesce(value, 0) AS value) FROM ({SQL_DIRTY_EVENTS})")
def d3_null_fill(spark, folder):
    return clean.fill_numeric_nulls(dirty_events(spark, folder))


_SQL_FINITE = "CASE WHEN isnan(value) OR isinf(value) THEN {0} ELSE value END"


@check(f"SELECT * REPLACE ({_SQL_FINITE.format('0.0')} AS value) FROM ({SQL_DIRTY_EVENTS})")
def d4_non_finite_to_zero(spark, folder):
    return clean.zero_non_finite(dirty_events(spark, folder))


@check(
    f"SELECT * REPLACE ({_SQL_FINITE.format('0.0')} AS value) FROM"
    f" (SELECT * REPLACE (coalesce(value, 0) AS value) FROM ({SQL_DIRTY_EVENTS}))"
)
def d4_all_repairs(spark, folder):
    return clean.clean_values(dirty_events(spark, folder))


def _sql_nulls(source: str, columns: list[str]) -> str:
    return (
        f"WITH t AS ({source}) SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM t" for c in columns
        )
        + ") WHERE nulls > 0"
    )


@check(
    _sql_nulls(SQL_DIRTY_EVENTS, ["event_id", "ts", "user_id", "event_type", "value", "props"])
)
def d5_null_profile(spark, folder):
    return quality.null_profile(dirty_events(spark, folder))


@check(
    _sql_nulls(
        "SELECT * REPLACE (CASE WHEN lower(o_orderstatus) IN ('nan', 'inf', '-inf', 'null', 'none')"
        f" THEN NULL ELSE o_orderstatus END AS o_orderstatus) FROM ({SQL_DIRTY_ORDERS})",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    )
)
def d5_null_profile_of_text(spark, folder):
    return quality.null_profile(clean.text_table(clean.clean_values(dirty_orders(spark, folder))))


# Layouts in which event times are written, and what of the time each of them keeps.
_MIXED = (
    ("MMM d, yyyy h:mm a", "date_trunc('minute', ts)"),
    ("d MMMM yyyy hh:mm a", "date_trunc('minute', ts)"),
    ("yyyyMMddHHmmss", "date_trunc('second', ts)"),
    ("yyyy-MM-dd'T'HH:mm'+07'", "date_trunc('minute', ts) - INTERVAL 7 HOUR"),
    ("EEE MMM d HH:mm:ss yyyy", "date_trunc('second', ts)"),
    ("yyyy/MM/dd HH:mm:ss", "date_trunc('second', ts)"),
    ("MM/dd/yyyy hh:mm:ssa", "date_trunc('second', ts)"),
    ("'on' yyyy-MM-dd", "NULL"),
)


@check(
    "SELECT event_id, CAST(CASE event_id % 8 "
    + " ".join(f"WHEN {i} THEN {kept}" for i, (_, kept) in enumerate(_MIXED))
    + " END AS TIMESTAMP) AS seen_time FROM events"
)
def d6_mixed_layouts(spark, folder):
    """One column in eight layouts: half days, digits alone, hour offsets, a year at the end, and one that is no time."""
    case = F.when(F.lit(False), F.lit(""))
    for i, (layout, _) in enumerate(_MIXED):
        case = case.when(F.col("event_id") % len(_MIXED) == i, F.date_format("ts", layout))
    return infer.coerce_datetimes(table(spark, folder, "events").select("event_id", case.alias("seen_time")))


@check(
    "SELECT 'seen_time' AS column_name, count(*) FILTER (event_id % 8 = 7) AS lost FROM events"
)
def d6_lost_datetimes(spark, folder):
    """How many texts of a column no layout fits."""
    layout = F.when(F.col("event_id") % 8 == 7, F.date_format("ts", "'on' yyyy-MM-dd")).otherwise(
        F.date_format("ts", "MMM d, yyyy h:mm a")
    )
    return infer.lost_datetimes(table(spark, folder, "events").select(layout.alias("seen_time")), ["seen_time"])


@check(
    "SELECT o_orderkey, o_totalprice, coalesce(try_strptime(d, '%Y-%m-%d %H:%M:%S'),"
    " try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%m/%d/%Y')) AS order_date FROM"
    " (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')"
    " WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN 'bad'"
    " ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d FROM orders)"
)
def d6_datetime_coercion(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    rendered = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(key % 4 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 4 == 2, "bad")
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .alias("order_date"),
    )
    return infer.coerce_datetimes(rendered)


@check(
    "SELECT o_orderkey, o_totalprice AS price, o_orderpriority AS priority,"
    " CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END AS key_text"
    " FROM orders"
)
def d7_numeric_inference(spark, folder):
    """Two text columns hold only numbers and convert, one does not."""
    key = F.col("o_orderkey")
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.when(key % 5 == 0, "").otherwise(key.cast("string")).alias("key_text"),
    )
    return infer.infer_numbers(texts)


@check(
    "SELECT o_orderkey, o_orderkey AS code, CAST(o_orderkey + 9007199254740992 AS BIGINT) AS long_code,"
    " CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey + 9007199254740992 AS BIGINT) END AS gaps"
    " FROM orders"
)
def d7_integer_columns(spark, folder):
    """Whole numbers stay exact, with leading zeros or 16 digits, with gaps or without."""
    key = F.col("o_orderkey")
    long_code = (key + F.lit(9007199254740992)).cast("string")
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.lpad(key.cast("string"), 10, "0").alias("code"),
        long_code.alias("long_code"),
        F.when(key % 5 > 0, long_code).otherwise("").alias("gaps"),
    )
    return infer.infer_numbers(texts)


@check(f"SELECT * REPLACE ({_SQL_FINITE.format('NULL')} AS value) FROM ({SQL_DIRTY_EVENTS})")
def d8_non_finite_to_null(spark, folder):
    return clean.null_non_finite(dirty_events(spark, folder))


_SQL_EVENT_TEXT = (
    "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,"
    " CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props"
    " FROM events"
)


@check(_SQL_EVENT_TEXT)
def d9_datetime_text(spark, folder):
    return clean.text_table(table(spark, folder, "events"))


_SENTINELS = "('nan', 'inf', '-inf', 'null', 'none')"


@check(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,"
    f" CASE WHEN lower(o_orderstatus) IN {_SENTINELS} THEN NULL ELSE o_orderstatus END AS o_orderstatus,"
    " CAST(o_totalprice AS VARCHAR) AS o_totalprice,"
    " strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"
    f" FROM ({SQL_DIRTY_ORDERS})"
)
def d10_sentinels_to_null(spark, folder):
    return clean.text_table(dirty_orders(spark, folder))


@check(
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,"
    " CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,"
    " CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,"
    " CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax, l_returnflag,"
    " l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem"
)
def d13_text_table(spark, folder):
    return clean.text_table(table(spark, folder, "lineitem"))


@check(
    "SELECT CAST(event_id AS VARCHAR) AS event_id,"
    " CAST(CAST(floor(value * 100) AS BIGINT) * 1000000.0::DOUBLE AS VARCHAR) AS large,"
    " CAST((1 + event_id % 9) / 1024.0::DOUBLE AS VARCHAR) AS small,"
    " CAST(-CAST(floor(value) AS BIGINT) * 10000000.0::DOUBLE - 0.5 AS VARCHAR) AS negative FROM events"
)
def d13_plain_numbers(spark, folder):
    """Numbers that a plain cast would write with an exponent."""
    events = table(spark, folder, "events")
    return clean.text_table(
        events.select(
            "event_id",
            (F.floor(F.col("value") * 100).cast("bigint") * F.lit(1000000.0)).alias("large"),
            ((1 + F.col("event_id") % 9) / F.lit(1024.0)).alias("small"),
            (-F.floor("value").cast("bigint") * F.lit(10000000.0) - 0.5).alias("negative"),
        )
    )
