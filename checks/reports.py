"""Ledgers, progress and reconciliation, and the scalar functions behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.data import KEYS, TABLES, all_tables, sql_counts, table
from tablewharf.functions import names
from tablewharf.functions import text as X
from tablewharf.operators import chunks, clean, fingerprints, ledger, upsert
from tablewharf.sources.files import row_counts

_SQL_LEDGER = """
    SELECT event_id, 'user_' || user_id AS table_name,
           CASE event_type WHEN 'click' THEN 'processing' WHEN 'view' THEN 'completed'
                WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'retrying' ELSE 'empty' END AS status,
           ts AS logged_at, CAST(CAST(floor(value) AS BIGINT) % 101 AS INTEGER) AS progress,
           event_id AS src_rows,
           CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS dst_rows,
           CASE WHEN event_type = 'error' THEN props END AS error,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END
               AS level
    FROM events
"""


def event_ledger(spark, folder):
    """Every event read as one status message about the table of its user."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id")).alias("table_name"),
        F.when(kind == "click", "processing")
        .when(kind == "view", "completed")
        .when(kind == "error", "failed")
        .when(kind == "signup", "retrying")
        .otherwise("empty")
        .alias("status"),
        F.col("ts").alias("logged_at"),
        (F.floor("value").cast("bigint") % 101).cast("int").alias("progress"),
        F.col("event_id").alias("src_rows"),
        F.when(kind != "error", F.col("event_id")).alias("dst_rows"),
        F.when(kind == "error", F.col("props")).alias("error"),
        F.when(kind == "error", "ERROR")
        .when(kind == "signup", "WARNING")
        .otherwise("INFO")
        .alias("level"),
    )


_SQL_CURRENT = (
    f"SELECT * FROM ({_SQL_LEDGER}) QUALIFY row_number() OVER"
    " (PARTITION BY table_name ORDER BY logged_at DESC, event_id DESC) = 1"
)


@check(_SQL_CURRENT)
def h1_current_status(spark, folder):
    return ledger.current_status(event_ledger(spark, folder), order_by=["logged_at", "event_id"])


@check(
    "WITH m AS (SELECT (min(o_orderkey) + max(o_orderkey)) // 2 AS middle FROM orders),"
    " s AS (SELECT o_orderkey AS k FROM orders, m WHERE o_orderkey < middle),"
    " b AS (SELECT min(k) AS lo, (max(k) - min(k) + 8) // 8 AS w FROM s),"
    " x AS (SELECT CAST((k - lo) // w AS BIGINT) AS chunk, count(*) AS n FROM s, b GROUP BY 1),"
    " y AS (SELECT CAST((o_orderkey - lo) // w AS BIGINT) AS chunk, count(*) AS n FROM orders, b GROUP BY 1)"
    " SELECT chunk, coalesce(x.n, 0) AS total_rows, coalesce(y.n, 0) AS rows_processed,"
    " CAST(CASE WHEN x.n > 0 THEN round(coalesce(y.n, 0) / x.n * 100) ELSE 0 END AS INTEGER) AS progress,"
    " CASE WHEN coalesce(y.n, 0) > coalesce(x.n, 0) THEN 'surplus' WHEN y.n = x.n THEN 'completed'"
    " ELSE 'running' END AS status FROM x FULL JOIN y USING (chunk)"
)
def h2_surplus_rows(spark, folder):
    """Rows loaded beyond the source's keys, the lower half of the key range, show up as surplus."""
    orders = table(spark, folder, "orders")
    low, high, _ = chunks.key_bounds(orders, "o_orderkey")
    return chunks.chunk_progress(orders.where(F.col("o_orderkey") < (low + high) // 2), orders, "o_orderkey", 8)


@check(
    "WITH b AS (SELECT min(o_orderkey) AS lo, (max(o_orderkey) - min(o_orderkey) + 16) // 16 AS w"
    " FROM orders), s AS (SELECT CAST((o_orderkey - lo) // w AS BIGINT) AS chunk,"
    " o_orderdate < TIMESTAMP '1998-01-01' AS done FROM orders, b)"
    " SELECT chunk, count(*) AS total_rows, count(*) FILTER (done) AS rows_processed,"
    " CAST(round(count(*) FILTER (done) / count(*) * 100) AS INTEGER) AS progress,"
    " CASE WHEN count(*) FILTER (done) >= count(*) THEN 'completed' ELSE 'running' END AS status"
    " FROM s GROUP BY chunk"
)
def h2_chunk_progress(spark, folder):
    orders = table(spark, folder, "orders")
    loaded = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return chunks.chunk_progress(orders, loaded, "o_orderkey", 16)


_SQL_VIEW = (
    "SELECT table_name, coalesce(status, 'pending') AS status, coalesce(src_rows, 0) AS src_rows,"
    " coalesce(dst_rows, 0) AS dst_rows, coalesce(progress, 0) AS progress, CAST(0 AS INTEGER) AS"
    " batch_rows, error"
    f" FROM ({_SQL_CURRENT})"
)


def _current(spark, folder):
    rows = ledger.current_status(event_ledger(spark, folder), order_by=["logged_at", "event_id"])
    unknown = F.lit(None).cast("int")
    return rows.withColumn("batch_rows", unknown)


@check(_SQL_VIEW)
def h3_progress_view(spark, folder):
    return ledger.progress_view(_current(spark, folder))


@check(f"SELECT * FROM ({_SQL_VIEW}) WHERE status = 'processing'")
def h3_tables_in_progress(spark, folder):
    return ledger.progress_view(_current(spark, folder), only="processing")


_SQL_SPANS = (
    f"SELECT max(logged_at) AS ended_at, min(logged_at) AS started_at, table_name FROM ({_SQL_LEDGER}) GROUP BY 3"
)


@check(
    f"WITH c AS ({_SQL_CURRENT}), s AS ({_SQL_SPANS}), a AS (SELECT count(*) AS total,"
    " count(*) FILTER (status = 'completed') AS done, count(*) FILTER (status = 'failed') AS failed,"
    " count(*) FILTER (status = 'empty') AS nothing,"
    " date_sub('second', min(started_at), max(ended_at)) AS sec"
    " FROM c JOIN s USING (table_name))"
    " SELECT CASE WHEN done + failed + nothing >= total THEN 'completed' ELSE 'running' END AS status,"
    " printf('%02d:%02d:%02d', sec // 3600, sec % 3600 // 60, sec % 60) AS elapsed,"
    " total AS total_tables, done AS completed_tables, failed AS failed_tables,"
    " CAST(CASE WHEN total > 0 THEN round(done / total * 100) ELSE 0 END AS INTEGER) AS progress FROM a"
)
def h4_run_summary(spark, folder):
    rows = event_ledger(spark, folder)
    return ledger.run_summary(ledger.with_spans(rows, order_by=["logged_at", "event_id"]))


@check(f"SELECT status, count(*) AS tables FROM ({_SQL_CURRENT}) GROUP BY 1")
def h4_status_counts(spark, folder):
    return ledger.status_counts(_current(spark, folder))


@check(
    f"WITH s AS ({sql_counts()}), d AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT ({', '.join(KEYS[t])})) AS n FROM {t}" for t in TABLES
    )
    + ") SELECT table_name, total_rows AS src_rows, n AS dst_rows, 'completed' AS status,"
    " CASE WHEN total_rows = n THEN '[OK]' ELSE '[!]' END AS mark FROM s JOIN d USING (table_name)"
)
def h5_reconciliation(spark, folder):
    """Source rows against one row per declared key; only lineitem loses rows."""
    tables = all_tables(spark, folder)
    loaded = {t: upsert.latest_per_key(df.select(*KEYS[t]), KEYS[t]) for t, df in tables.items()}
    return ledger.reconcile(row_counts(tables), row_counts(loaded))


@check(
    f"WITH c AS ({_SQL_CURRENT}), s AS (SELECT 'user_' || user_id AS table_name, count(*) AS n"
    " FROM events GROUP BY 1), d AS (SELECT 'user_' || user_id AS table_name, count(*) AS n"
    " FROM events WHERE event_type <> 'purchase' OR value < 50 GROUP BY 1)"
    " SELECT table_name, coalesce(s.n, 0) AS src_rows, coalesce(d.n, 0) AS dst_rows, status,"
    " CASE WHEN status = 'completed' AND coalesce(s.n, 0) = coalesce(d.n, 0) THEN '[OK]'"
    " WHEN status = 'completed' THEN '[!]' WHEN status = 'failed' THEN '[X]' ELSE '[ ]' END AS mark"
    " FROM s FULL JOIN d USING (table_name) LEFT JOIN c USING (table_name)"
)
def h5_reconciliation_with_status(spark, folder):
    events = table(spark, folder, "events").withColumn(
        "table_name", F.concat(F.lit("user_"), F.col("user_id"))
    )

    def counts(df):
        return df.groupBy("table_name").agg(F.count(F.lit(1)).alias("total_rows"))

    kept = events.where((F.col("event_type") != "purchase") | (F.col("value") < 50))
    return ledger.reconcile(counts(events), counts(kept), _current(spark, folder))


@check(
    f"SELECT logged_at, level, table_name, status FROM ({_SQL_LEDGER}) ORDER BY logged_at DESC, event_id DESC LIMIT 100"
)
def h6_recent_messages(spark, folder):
    rows = ledger.recent_messages(event_ledger(spark, folder), ["logged_at", "event_id"])
    return rows.select("logged_at", "level", "table_name", "status")


@check(
    f"SELECT logged_at, level, table_name, error FROM ({_SQL_LEDGER}) WHERE level = 'ERROR'"
    " ORDER BY logged_at DESC, event_id DESC LIMIT 100"
)
def h6_recent_errors(spark, folder):
    rows = ledger.recent_messages(event_ledger(spark, folder), ["logged_at", "event_id"], level="ERROR")
    return rows.select("logged_at", "level", "table_name", "error")


@check(
    "SELECT event_id, 'backup_' || strftime(ts, '%Y_%m_%d_%H%M%S') AS snapshot,"
    " lower(upper(event_type)) AS lowered, starts_with(event_type, 'p') AS is_purchase,"
    " left(props, 50) AS head, event_type || '|' || user_id AS parts, event_type GLOB '*[ck]' AS matches, least(event_id // 7, user_id) AS lesser,"
    " greatest(event_id // 7, user_id) AS greater,"
    " printf('%02d:%02d:%02d', event_id // 3600, event_id % 3600 // 60, event_id % 60) AS duration,"
    " CAST(CASE WHEN event_id > 0 THEN round(user_id / event_id * 100) ELSE 0 END AS INTEGER) AS share"
    " FROM events"
)
def fn_scalars(spark, folder):
    events = table(spark, folder, "events")
    seventh = F.call_function("div", F.col("event_id"), F.lit(7))
    listed = F.concat_ws(" , ", "event_type", F.col("user_id").cast("string"))
    return events.select(
        "event_id",
        names.snapshot_name("backup_{YYYY}_{MM}_{DD}_{HH}{mm}{ss}", F.col("ts")).alias("snapshot"),
        F.lower(F.upper("event_type")).alias("lowered"),
        F.startswith("event_type", F.lit("p")).alias("is_purchase"),
        F.left("props", F.lit(50)).alias("head"),
        F.array_join(names.split_names(listed), "|").alias("parts"),
        names.matches_glob(F.col("event_type"), "*[ck]").alias("matches"),
        F.least(seventh, "user_id").alias("lesser"),
        F.greatest(seventh, "user_id").alias("greater"),
        X.duration_text(F.col("event_id")).alias("duration"),
        X.percent(F.col("user_id"), F.col("event_id")).alias("share"),
    )


def _spoiled_copy(orders):
    """Orders loaded as text, with some lost, changed and doubled, and some that are not in the source."""
    rest = F.col("o_orderkey") % 997
    price = F.when(rest == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice")
    copies = F.explode(F.when(rest == 2, F.array(F.lit(0), F.lit(0))).when(rest == 3, F.array(F.lit(0), F.lit(90_000_000))).otherwise(F.array(F.lit(0))))
    changed = orders.where(rest > 0).select(*[price if c == "o_totalprice" else F.col(c) for c in orders.columns], copies.alias("shift"))
    return clean.text_table(changed.withColumn("o_orderkey", F.col("o_orderkey") + F.col("shift")).drop("shift"))


_SQL_SPOILED = """
    SELECT o_orderkey AS k, CASE o_orderkey % 997 WHEN 0 THEN 'lost' WHEN 1 THEN 'changed' ELSE 'doubled' END AS kind,
           CAST(1 AS BIGINT) AS source_rows, CAST(CASE o_orderkey % 997 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS destination_rows
    FROM orders WHERE o_orderkey % 997 < 3
    UNION ALL SELECT o_orderkey + 90000000, 'surplus', 0, 1 FROM orders WHERE o_orderkey % 997 = 3
"""


@check(f"SELECT CAST(k AS VARCHAR) AS o_orderkey, kind, source_rows, destination_rows FROM ({_SQL_SPOILED})")
def h5_content_differences(spark, folder):
    """The rows of a copy that are lost, changed, doubled or surplus, found through chunk fingerprints."""
    orders = table(spark, folder, "orders")
    return fingerprints.reconcile_content(orders, _spoiled_copy(orders), ["o_orderkey"])[1]


@check(
    f"WITH x AS ({_SQL_SPOILED}), b AS (SELECT min(o_orderkey) AS lo, (max(o_orderkey) - min(o_orderkey) + 4096) // 4096 AS w"
    " FROM orders), f AS (SELECT DISTINCT CASE WHEN k >= 90000000 THEN 4096 ELSE (k - lo) // w END AS chunk FROM x, b),"
    " s AS (SELECT (o_orderkey - lo) // w AS chunk, count(*) AS n FROM orders, b GROUP BY 1),"
    " e AS (SELECT CASE WHEN k >= 90000000 THEN 4096 ELSE (k - lo) // w END AS chunk, sum(destination_rows - source_rows) AS more"
    " FROM x, b GROUP BY 1) SELECT CAST(chunk AS BIGINT) AS chunk, coalesce(n, 0) AS source_rows,"
    " CAST(coalesce(n, 0) + coalesce(more, 0) AS BIGINT) AS destination_rows FROM f LEFT JOIN s USING (chunk) LEFT JOIN e USING (chunk)"
)
def h5_chunk_fingerprints(spark, folder):
    """The chunks of a copy whose fingerprints differ; where a row was only changed the counts agree."""
    orders = table(spark, folder, "orders")
    return fingerprints.reconcile_content(orders, _spoiled_copy(orders), ["o_orderkey"])[0]
