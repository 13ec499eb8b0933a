"""Scans, catalogs, keys, sizes and chunks."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.data import KEYS, TABLES, all_tables, sql_counts, table
from tablewharf.functions.names import snapshot_name
from tablewharf.operators import chunks, keys, quality, selection
from tablewharf.sources import catalog, jdbc, records
from tablewharf.sources.files import read_table, row_counts


@check("SELECT * FROM customer")
def a1_full_scan(spark, folder):
    return read_table(spark, folder, "customer")


@check("SELECT * FROM lineitem")
def a1_full_scan_large(spark, folder):
    return read_table(spark, folder, "lineitem")


@check("SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def a2_page(spark, folder):
    return chunks.read_page(table(spark, folder, "orders"), "o_orderkey", 1000, 500)


@check("SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 12000")
def a2_deep_page(spark, folder):
    orders = table(spark, folder, "orders")
    return chunks.read_page(orders, "o_orderkey", 12000, 500, rows_per_chunk=5000)


@check("SELECT * FROM orders ORDER BY o_orderkey LIMIT 7500 OFFSET 3000")
def a2_wide_page(spark, folder):
    """Half of the table: numbered range by range, not gathered in one task."""
    orders = table(spark, folder, "orders")
    return chunks.read_page(orders, "o_orderkey", 3000, 7500, rows_per_chunk=2000)


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
)


@check(f"SELECT * FROM lineitem ORDER BY {', '.join(_LINE_ORDER)} LIMIT 20000 OFFSET 10000")
def a2_page_composite(spark, folder):
    """A page in the order of several columns, numbers, dates and text."""
    return chunks.read_page(table(spark, folder, "lineitem"), _LINE_ORDER, 10000, 20000)


@check(
    "SELECT CAST(n * 12 // total AS BIGINT) AS chunk, count(*) AS rows_in_chunk, min(c_name) AS min_key,"
    " max(c_name) AS max_key FROM (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS n,"
    " count(*) OVER () AS total FROM customer) GROUP BY 1"
)
def b3_manifest_text_key(spark, folder):
    manifest = chunks.even_manifest(table(spark, folder, "customer"), ["c_name"], 12)
    return manifest.withColumns({"min_key": F.col("min_key.c_name"), "max_key": F.col("max_key.c_name")})


@check(sql_counts())
def a4_row_counts(spark, folder):
    return row_counts(all_tables(spark, folder))


_SQL_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'FLOAT[]' THEN 'array<float>' END"""


@check(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, CAST(row_number() OVER () AS INTEGER) AS position,"
        f" {_SQL_TYPES} AS data_type, (SELECT count(*) FROM {t}) AS total_rows FROM (DESCRIBE {t})"
        for t in TABLES
    )
)
def a5_catalog_inventory(spark, folder):
    tables = all_tables(spark, folder)
    return catalog.columns_of(spark, tables).join(row_counts(tables), "table_name")


def _sql_key_check(name: str) -> str:
    key = ", ".join(KEYS[name])
    missing = " OR ".join(f"{k} IS NULL" for k in KEYS[name])
    return (
        f"SELECT '{name}' AS table_name, count(*) AS total_rows,"
        f" count(DISTINCT ({key})) FILTER (NOT ({missing})) AS distinct_keys,"
        f" count(*) FILTER ({missing}) AS null_key_rows,"
        f" count(*) = count(DISTINCT ({key})) FILTER (NOT ({missing})) AS is_key FROM {name}"
    )


def key_checks(spark, folder) -> DataFrame:
    checks = [
        quality.key_check(df, KEYS[name]).select(F.lit(name).alias("table_name"), "*")
        for name, df in all_tables(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, checks)


@check(" UNION ALL ".join(_sql_key_check(t) for t in TABLES))
def a6_key_check(spark, folder):
    return key_checks(spark, folder)


@check(
    "WITH c AS (" + " UNION ALL ".join(_sql_key_check(t) for t in TABLES) + "), u AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal_position"
        for t in TABLES
        for i, c in enumerate(KEYS[t], start=1)
    )
    + ") SELECT 'main' AS table_schema, table_name, column_name,"
    " CAST(ordinal_position AS INTEGER) AS ordinal_position FROM c JOIN u USING (table_name) WHERE is_key"
)
def a6_key_discovery(spark, folder):
    """Keys that hold in the data become constraints; the metadata join finds their columns."""
    constraints = key_checks(spark, folder).select(
        F.concat("table_name", F.lit("_key")).alias("constraint_name"),
        F.lit("main").alias("table_schema"),
        "table_name",
        F.when(F.col("is_key"), "PRIMARY KEY").otherwise("INDEX").alias("constraint_type"),
    )
    usage = spark.createDataFrame(
        [(f"{t}_key", "main", t, c, i) for t in TABLES for i, c in enumerate(KEYS[t], start=1)],
        "constraint_name string, table_schema string, table_name string,"
        " column_name string, ordinal_position int",
    )
    return catalog.primary_keys(constraints, usage)


@check(
    "WITH t AS (SELECT *, 'backup_' || strftime(ts, '%Y_%m_%d') AS snapshot FROM events)"
    " SELECT * FROM t WHERE snapshot ="
    " (SELECT max(snapshot) FROM t WHERE snapshot GLOB 'backup_2024_01_*')"
)
def a8_latest_snapshot(spark, folder):
    tagged = table(spark, folder, "events").withColumn(
        "snapshot", snapshot_name("backup_{YYYY}_{MM}_{DD}", F.col("ts"))
    )
    return catalog.latest_rows(tagged, "snapshot", "backup_2024_01_*")


@check(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,"
    " json_extract_string(props, '$.note') AS note FROM events"
)
def a9_json_records(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return records.parse_records(events, "props", "k bigint, note string")


_SQL_TIER = """
    CASE WHEN total_rows < 1000 THEN 'tiny' WHEN total_rows < 10000 THEN 'small'
         WHEN total_rows < 100000 THEN 'medium' WHEN total_rows < 1000000 THEN 'large'
         ELSE 'huge' END AS tier,
    CAST(CASE WHEN total_rows < 1000 THEN 1000 WHEN total_rows < 10000 THEN 2000 ELSE 5000 END
         AS INTEGER) AS batch_rows"""


@check(
    "SELECT *," + _SQL_TIER + " FROM (SELECT event_id,"
    " CAST(floor(value * 10000) AS BIGINT) AS total_rows FROM events)"
)
def b1_size_tiers(spark, folder):
    sizes = table(spark, folder, "events").select(
        "event_id", F.floor(F.col("value") * 10000).cast("bigint").alias("total_rows")
    )
    return chunks.with_size_tier(sizes)


@check("SELECT *," + _SQL_TIER + f" FROM ({sql_counts()})")
def b1_table_profile(spark, folder):
    return chunks.with_size_tier(row_counts(all_tables(spark, folder)))


def _sql_manifest(name: str, key: str, n: int) -> str:
    return (
        f"WITH b AS (SELECT min({key}) AS lo, (max({key}) - min({key}) + {n}) // {n} AS w FROM {name})"
        f" SELECT CAST(({key} - lo) // w AS BIGINT) AS chunk, count(*) AS rows_in_chunk,"
        f" min({key}) AS min_key, max({key}) AS max_key FROM {name}, b GROUP BY 1"
    )


@check(_sql_manifest("orders", "o_orderkey", 8))
def b3_chunk_manifest(spark, folder):
    return chunks.chunk_manifest(table(spark, folder, "orders"), "o_orderkey", 8)


@check(_sql_manifest("lineitem", "l_orderkey", 1000))
def b3_chunk_manifest_fine(spark, folder):
    return chunks.chunk_manifest(table(spark, folder, "lineitem"), "l_orderkey", 1000)


@check(
    "WITH m AS (SELECT date_diff('microsecond', TIMESTAMP '1970-01-01', ts) AS k, ts FROM events),"
    " b AS (SELECT min(k) AS lo, (max(k) - min(k) + 24) // 24 AS w FROM m)"
    " SELECT CAST((k - lo) // w AS BIGINT) AS chunk, count(*) AS rows_in_chunk, min(ts) AS min_key,"
    " max(ts) AS max_key FROM m, b GROUP BY 1"
)
def b3_chunk_manifest_by_time(spark, folder):
    return chunks.chunk_manifest(table(spark, folder, "events"), "ts", 24)


@check(
    f"SELECT * FROM ({sql_counts()})"
    " WHERE table_name IN ('orders', 'lineitem', 'customer', 'events') AND table_name <> 'events'"
)
def c1_table_selection(spark, folder):
    counts = row_counts(all_tables(spark, folder))
    return selection.select_tables(counts, "orders, lineitem ,customer,events", " events")


@check(
    f"SELECT * FROM ({sql_counts()})"
    " WHERE (table_name GLOB '*s' OR table_name GLOB 'n?tion') AND NOT table_name GLOB '[ed]*'"
)
def c1_table_selection_by_pattern(spark, folder):
    counts = row_counts(all_tables(spark, folder))
    return selection.select_tables(counts, "*s, n?tion", "[ed]*", globs=True)


_TARGET_COLUMNS = ["id", "loaded_at", "event_id", "event_type", "value", "k", "comment"]


@check(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS VARCHAR) AS value,"
    " json_extract_string(props, '$.k') AS k FROM events"
)
def c3_aligned_records(spark, folder):
    parsed = records.parse_records(table(spark, folder, "events"), "props", "k bigint, note string")
    return selection.align(parsed, _TARGET_COLUMNS)


@check(
    "SELECT 'ts' AS field, count(ts) AS filled_records FROM events UNION ALL"
    " SELECT 'user_id', count(user_id) FROM events UNION ALL"
    " SELECT 'note', count(json_extract_string(props, '$.note')) FROM events"
)
def c3_unmatched_fields(spark, folder):
    parsed = records.parse_records(table(spark, folder, "events"), "props", "k bigint, note string")
    return selection.unmatched_fields(parsed, _TARGET_COLUMNS)


_KEY_TABLES = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "labels": ("doc_id", "quality", "toxic"),
    "lineitem": _LINE_COLUMNS,
}


def _sql_key(name: str, columns: tuple[str, ...]) -> str:
    whole = ", ".join(columns)
    given = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT '{name}' AS t, [{', '.join(repr(c) for c in columns)}] AS cols,"
        f" count(*) = count(DISTINCT {'(' + whole + ')' if len(columns) > 1 else whole}) AND bool_and({given}) AS k FROM {name}"
    )


_SQL_KEYS = " UNION ALL ".join(
    _sql_key(name, some) for name, columns in _KEY_TABLES.items() for n in (1, 2, 3) for some in combinations(columns, n)
)


@check(
    f"WITH c AS MATERIALIZED ({_SQL_KEYS}) SELECT t AS table_name, array_to_string(cols, ', ') AS key_columns FROM c"
    " WHERE k AND NOT EXISTS (SELECT 1 FROM c AS d WHERE d.t = c.t AND d.k AND len(d.cols) < len(c.cols)"
    " AND list_has_all(c.cols, d.cols))"
)
def a6_minimal_keys(spark, folder):
    """All smallest keys of up to three columns in six tables, without any declaration."""
    found = [
        (name, ", ".join(key))
        for name, columns in _KEY_TABLES.items()
        for key in keys.minimal_keys(table(spark, folder, name).select(*columns))
    ]
    return spark.createDataFrame(found, "table_name string, key_columns string")


@check(
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 100 = 99 THEN event_type END AS late,"
    " CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS mixed, value AS amount FROM events"
)
def a9_union_of_fields(spark, folder):
    """Records whose fields are found in the data: one is in a hundredth of them, one holds numbers and texts."""
    key = F.col("event_id")
    fields = F.struct(
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(key % 100 == 99, F.col("event_type")).alias("late"),
        F.when(key % 2 == 0, F.col("user_id")).alias("number"),
        F.when(key % 2 == 1, F.col("event_type")).alias("text"),
        F.col("value").alias("amount"),
    )
    written = F.regexp_replace(F.to_json(fields), '"(number|text)":', '"mixed":')
    events = table(spark, folder, "events").select("event_id", written.alias("record"))
    found = records.parse_records(events, "record")
    return found.select("event_id", "k", "late", "mixed", F.col("amount").cast("double").alias("amount"))


@check("SELECT * FROM conversations")
def b3_range_predicates(spark, folder):
    """The clauses of a text and composite key, as a database would get them: together they give every row once."""
    rows, key = table(spark, folder, "conversations"), ("role", "conv_id", "turn")
    clauses = jdbc.tuple_predicates(key, jdbc.key_starts(rows, key, 8))
    return reduce(DataFrame.unionAll, [rows.where(clause) for clause in clauses])
