"""Whole copies, snapshots and streams: written out, then read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import check
from checks.data import (
    KEYS,
    SQL_DIRTY_ORDERS,
    TABLES,
    all_tables,
    dirty_orders,
    sql_trim,
    table,
)
from tablewharf.functions.names import snapshot_name
from tablewharf.operators import ledger as reports
from tablewharf.plans.database import catalog_jobs, copy_database
from tablewharf.plans.run import copy_tables
from tablewharf.plans.table_job import TableJob, loaded_rows, run_table
from tablewharf.sinks import snapshots
from tablewharf.sinks.registry import load_registry
from tablewharf.sinks.workspace import new_folder
from tablewharf.sources import records
from tablewharf.sources.catalog import catalog_tables
from tablewharf.sources.files import row_counts
from tablewharf.streaming import incremental, progress
from tablewharf.streaming.buckets import BucketedTable

_SENTINELS = "('nan', 'inf', '-inf', 'null', 'none')"

_SQL_COPIED_ORDERS = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           CASE WHEN lower(o_orderstatus) IN {_SENTINELS} THEN NULL ELSE o_orderstatus END
               AS o_orderstatus,
           CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
           {sql_trim("o_orderpriority")} AS o_orderpriority
    FROM ({SQL_DIRTY_ORDERS})
"""


def _repeated(orders):
    """Every order three times: as it is, as an exact copy and at a lower price."""
    cheaper = orders.withColumn("o_totalprice", F.col("o_totalprice") / 2)
    return cheaper.unionByName(orders).unionByName(orders)


def flagship(spark, folder):
    """Dirty, repeated orders through the whole copy, as one plan."""
    job = TableJob("orders", _repeated(dirty_orders(spark, folder)), ("o_orderkey",), ("o_totalprice",))
    return loaded_rows(job, unique=False)


@check(_SQL_COPIED_ORDERS)
def g2_table_copy_plan(spark, folder):
    return flagship(spark, folder)


@check(_SQL_COPIED_ORDERS)
def g2_table_copy_written(spark, folder):
    source = _repeated(dirty_orders(spark, folder))
    job = TableJob("orders", source, ("o_orderkey",), ("o_totalprice",))
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)


@check(
    "SELECT DISTINCT " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in ("quality", "toxic")
    ) + " FROM labels"
)
def g2_table_copy_without_key(spark, folder):
    job = TableJob("labels", table(spark, folder, "labels").drop("doc_id"))
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)


@check(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(coalesce("
    "try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%m/%d/%Y')), '%Y-%m-%d %H:%M:%S') AS order_date,"
    " CAST(o_totalprice AS VARCHAR) AS price, o_orderpriority AS priority,"
    " CASE WHEN o_orderkey % 5 > 0 THEN CAST(CAST(o_orderkey AS DOUBLE) AS VARCHAR) END AS code"
    " FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')"
    " WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'bad' END AS d FROM orders)"
)
def g2_table_copy_inferred(spark, folder):
    """Text columns recover their types before they are written out."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(day, "MM/dd/yyyy"))
        .otherwise("bad")
        .alias("order_date"),
        F.concat(F.lit(" "), F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.when(key % 5 == 0, "").otherwise(key.cast("string")).alias("code"),
    )
    job = TableJob("orders", texts, ("o_orderkey",), infer_types=True)
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)


def _sql_ledger_row(name: str) -> str:
    key = ", ".join(KEYS[name])
    texts = {
        "documents": ["text", "lang", "source"],
        "pages": ["url", "html"],
        "benchmark": ["text"],
        "conversations": ["role", "text"],
    }.get(name, [])
    refused = " OR ".join(f"strlen({sql_trim(c)}) > 8192" for c in texts) or "false"
    return (
        f"SELECT '{name}' AS table_name, 'completed' AS status, count(*) AS src_rows,"
        f" count(DISTINCT ({key})) FILTER (NOT ({refused})) AS dst_rows,"
        f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS duplicates,"
        f" count(*) FILTER (NOT ({refused})) - count(DISTINCT ({key})) FILTER (NOT ({refused}))"
        f" AS superseded, count(*) FILTER ({refused}) AS quarantined FROM {name}"
    )


@check(" UNION ALL ".join(_sql_ledger_row(t) for t in TABLES))
def g3_all_tables(spark, folder):
    """All tables in one run, with a text limit that some documents and pages exceed."""
    jobs = [
        TableJob(name, df, KEYS[name], count_duplicates=True, limits={"max_text_bytes": 8192})
        for name, df in all_tables(spark, folder).items()
    ]
    ledger = copy_tables(spark, jobs, new_folder(spark, "run"), at_once=4)
    return reports.current_status(ledger.rows(), order_by=["attempt", "logged_at"]).select(
        "table_name", "status", "src_rows", "dst_rows", "duplicates", "superseded", "quarantined"
    )


@check("SELECT * REPLACE (s_acctbal + 1 AS s_acctbal) FROM supplier")
def f6_full_refresh(spark, folder):
    """The second version replaces the first; readers of the name see only it."""
    base = new_folder(spark, "refresh")
    namespace = snapshots.run_namespace(
        spark, "wharf_refresh", datetime(2024, 1, 2), dated=False, folder=base
    )
    supplier = table(spark, folder, "supplier")
    snapshots.full_refresh(supplier, namespace, "supplier", f"{base}/version-1")
    raised = supplier.withColumn("s_acctbal", F.col("s_acctbal") + 1)
    return snapshots.full_refresh(raised, namespace, "supplier", f"{base}/version-2")


@check("SELECT * REPLACE (s_acctbal + 1 AS s_acctbal) FROM supplier")
def f6_refresh_from_itself(spark, folder):
    """A refresh may read the table it replaces, under the same folder."""
    base = new_folder(spark, "refresh")
    namespace = snapshots.run_namespace(
        spark, "wharf_refresh_itself", datetime(2024, 1, 2), dated=False, folder=base
    )
    first = snapshots.full_refresh(table(spark, folder, "supplier"), namespace, "supplier", base)
    raised = first.withColumn("s_acctbal", F.col("s_acctbal") + 1)
    return snapshots.full_refresh(raised, namespace, "supplier", base)


@check(
    "SELECT CAST(9007199254740992 + o_orderkey AS VARCHAR) AS code, lpad(CAST(o_orderkey AS VARCHAR),"
    " 12, '0') AS label, CAST(o_custkey AS VARCHAR) AS customer FROM orders"
)
def g2_table_copy_long_keys(spark, folder):
    """Text keys stay as they are where numbers are inferred; each of them loads."""
    key = F.col("o_orderkey")
    texts = table(spark, folder, "orders").select(
        (key + F.lit(9007199254740992)).cast("string").alias("code"),
        F.lpad(key.cast("string"), 12, "0").alias("label"),
        F.concat(F.lit("0"), F.col("o_custkey").cast("string")).alias("customer"),
    )
    job = TableJob("orders", texts, ("code", "label"), infer_types=True)
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)


@check(
    "SELECT 'backup_' || strftime(ts, '%Y_%m_%d') AS snapshot, count(*) AS total_rows"
    " FROM events GROUP BY 1"
)
def f9_snapshot_names(spark, folder):
    name = snapshot_name("backup_{YYYY}_{MM}_{DD}", F.col("ts"))
    events = table(spark, folder, "events")
    return events.groupBy(name.alias("snapshot")).agg(F.count(F.lit(1)).alias("total_rows"))


@check("SELECT 'wharf_2024_03_05' AS namespace, * FROM customer")
def f9_dated_snapshot(spark, folder):
    base = new_folder(spark, "dated")
    started = datetime(2024, 3, 5, 23, 59)
    namespace = snapshots.run_namespace(spark, "wharf_{YYYY}.{MM}.{DD}", started, folder=base)
    customer = table(spark, folder, "customer")
    written = snapshots.full_refresh(customer, namespace, "customer", f"{base}/customer")
    return written.select(F.lit(namespace).alias("namespace"), "*")


@check(
    "SELECT row_number() OVER (ORDER BY event_id) AS id, CAST(user_id AS VARCHAR) AS user_id,"
    " CAST(NULL AS VARCHAR) AS hn, event_type, CAST(event_id AS VARCHAR) AS event_id FROM events"
)
def f10_registry_load(spark, folder):
    """Exported JSON records, read back by a declared schema, replace the registry table."""
    base = new_folder(spark, "registry")
    exported = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    exported.write.json(f"{base}/export")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    parsed = records.read_records(spark, f"{base}/export", schema)
    namespace = snapshots.run_namespace(
        spark, "wharf_registry", datetime(2024, 1, 2), dated=False, folder=base
    )
    columns = ["id", "user_id", "hn", "event_type", "event_id"]
    load_registry(parsed, columns, namespace, "registry", f"{base}/table", dense_by="event_id")
    return spark.table(f"{namespace}.registry")


@check("SELECT event_id, ts, event_type, props FROM events")
def a9_exported_records(spark, folder):
    base = new_folder(spark, "export")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    table(spark, folder, "events").write.option("timestampNTZFormat", micros).json(f"{base}/export")
    schema = "event_id bigint, ts timestamp_ntz, event_type string, props string"
    return records.read_records(spark, f"{base}/export", schema)


@check(
    "SELECT 'archive_2024_05_06' AS namespace, table_name, total_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}"
        for t in ("customer", "nation", "region", "supplier")
    )
    + ")"
)
def g3_database_copy(spark, folder):
    """Two dated source namespaces; the newest is copied, less what the lists leave out."""
    base = new_folder(spark, "database")
    for day in (4, 5):
        names = ["region", "nation", "customer", "supplier", "part"] if day == 5 else ["region"]
        source = snapshots.run_namespace(
            spark, "wharf_source_{YYYY}_{MM}_{DD}", datetime(2024, 5, day), folder=base
        )
        for name in names:
            target = f"{base}/source-{day}/{name}"
            snapshots.full_refresh(table(spark, folder, name), source, name, target)
    jobs = catalog_jobs(spark, "LATEST:wharf_source_2024_*", exclude="part", keys=KEYS)
    namespace, _ = copy_database(
        spark, jobs, "archive_{YYYY}_{MM}_{DD}", base, started=datetime(2024, 5, 6), at_once=4
    )
    counts = row_counts(catalog_tables(spark, namespace))
    return counts.select(F.lit(namespace).alias("namespace"), "table_name", "total_rows")


@check("SELECT * FROM customer UNION ALL SELECT * FROM customer")
def f2_append_written(spark, folder):
    target = new_folder(spark, "append")
    customer = table(spark, folder, "customer")
    snapshots.append_rows(customer, target)
    snapshots.append_rows(customer, target)
    return spark.read.parquet(target)


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return incremental.file_stream(spark, folder, schema, pattern="events.parquet")


@check(
    "SELECT * FROM events QUALIFY row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def s1_incremental_upsert(spark, folder):
    target = new_folder(spark, "stream")
    key, order = ["user_id"], ["ts", "event_id"]
    incremental.upsert_stream(_event_stream(spark, folder), target, key, order)
    return incremental.current_table(spark, target, key, order)


@check(
    "SELECT event_type, count(*) AS rows_processed, max(ts) AS last_seen FROM events GROUP BY 1"
)
def s2_stream_progress(spark, folder):
    target = new_folder(spark, "progress")
    progress.progress_stream(_event_stream(spark, folder), target, ["event_type"], "ts")
    return progress.latest_progress(spark, target)


def _arrivals(spark, rows, spread_by, parts=4):
    """Rows written as that many files, to arrive one by one."""
    incoming = new_folder(spark, "incoming")
    rows.repartition(parts, spread_by).write.parquet(incoming)
    return incoming


@check(
    "SELECT *, 'current' AS state FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    " UNION ALL SELECT *, 'first' FROM events WHERE event_id % 3 > 0 QUALIFY row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def s1_bucketed_compaction(spark, folder):
    """Two thirds of the events arrive and are compacted, then the rest; the first base stays readable."""
    events = table(spark, folder, "events")
    target, key, order = new_folder(spark, "stream"), ("user_id",), ("ts", "event_id")
    incoming = _arrivals(spark, events.where("event_id % 3 > 0"), "event_id")
    kept = BucketedTable(spark, target, key, order, buckets=16)

    def run():
        stream = incremental.file_stream(spark, incoming, events.schema, files_per_batch=2)
        incremental.upsert_stream(stream, target, key, order)

    run()
    kept.compact()
    events.where("event_id % 3 = 0").coalesce(1).write.mode("append").parquet(incoming)
    run()
    kept.compact()
    now, first = kept.current(), kept.current(version=1)
    return now.withColumn("state", F.lit("current")).unionByName(first.withColumn("state", F.lit("first")))


@check("SELECT DISTINCT user_id, event_type, CAST(floor(value / 100) AS BIGINT) AS hundreds FROM events")
def s1_keyless_distinct(spark, folder):
    """Rows without a key that repeat within and across the files of a stream are kept once."""
    rows = table(spark, folder, "events").select(
        "user_id", "event_type", F.floor(F.col("value") / 100).cast("bigint").alias("hundreds"), "event_id"
    )
    incoming, target = _arrivals(spark, rows, "event_id"), new_folder(spark, "stream")
    schema = rows.drop("event_id").schema
    for _ in range(2):  # the second run finds nothing new
        stream = incremental.file_stream(spark, incoming, schema, files_per_batch=1)
        incremental.distinct_stream(stream, target)
    return incremental.distinct_table(spark, target)


def _keyless_events(events):
    """Events by their number, of which some have none, among them one with number 0."""
    number = F.when(F.col("event_id") % 10 == 3, None).otherwise(F.col("event_id") % 1000)
    return events.select(number.alias("number"), F.concat(F.lit(" "), F.col("event_type")).alias("kind"), "event_id", "ts")


@check(
    "SELECT CAST(event_id % 1000 AS VARCHAR) AS number, event_type AS kind, CAST(event_id AS VARCHAR) AS event_id,"
    " strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events WHERE event_id % 10 <> 3"
    " QUALIFY row_number() OVER (PARTITION BY event_id % 1000 ORDER BY event_id DESC) = 1"
)
def g2_null_keys(spark, folder):
    """Rows without a key are set aside; none of them is loaded as the row with key 0."""
    job = TableJob("events", _keyless_events(table(spark, folder, "events")), ("number",), ("event_id",))
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)


@check(
    "SELECT CAST(NULL AS VARCHAR) AS number, ' ' || event_type AS kind, CAST(event_id AS VARCHAR) AS event_id,"
    " strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, 'key number is null' AS refusal_reason FROM events WHERE event_id % 10 = 3"
)
def f4_raw_quarantine(spark, folder):
    """What is set aside keeps the values of the source: padding stays, NULL stays NULL."""
    job = TableJob("events", _keyless_events(table(spark, folder, "events")), ("number",), ("event_id",))
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).quarantine)


def _run_with_failure(spark, folder):
    """All tables in one run, of which orders cannot be read; its ledger."""

    def unreadable(job):
        raise RuntimeError("injected")

    jobs = [
        TableJob(name, df, KEYS[name], prepare=unreadable if name == "orders" else None)
        for name, df in all_tables(spark, folder).items()
    ]
    return copy_tables(
        spark, jobs, new_folder(spark, "run"), at_once=8, max_attempts=2, retry_seconds=0, reconciled=True
    )


def _sql_loaded(name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*) AS s, count(DISTINCT ({', '.join(KEYS[name])})) AS d FROM {name}"
    )


_SQL_LOADED = " UNION ALL ".join(_sql_loaded(t) for t in TABLES if t != "orders")


@check(
    f"SELECT table_name, d AS src_rows, d AS dst_rows, 'completed' AS status, '[OK]' AS mark FROM ({_SQL_LOADED})"
    " UNION ALL SELECT 'orders', 0, 0, 'failed', '[X]'"
)
def g3_run_reconciled(spark, folder):
    """What a run says it loaded against what its tables hold, with one table that failed."""
    return _run_with_failure(spark, folder).reconciliation()


@check(
    f"WITH t AS ({_SQL_LOADED}) SELECT 'INFO' AS level, table_name, 'started, attempt 1' AS message FROM t"
    " UNION ALL SELECT 'INFO', table_name, 'loaded ' || d || ' of ' || s || ' rows' ||"
    " CASE WHEN s > d THEN ', ' || (s - d) || ' superseded' ELSE '' END FROM t"
    " UNION ALL SELECT 'INFO', table_name, '[OK] ' || d || ' of ' || d || ' rows' FROM t"
    " UNION ALL SELECT * FROM (VALUES ('INFO', 'orders', 'started, attempt 1'), ('ERROR', 'orders', 'failed: injected'),"
    " ('WARNING', 'orders', 'trying again, 2 of 2'), ('INFO', 'orders', 'started, attempt 2'),"
    " ('ERROR', 'orders', 'failed: injected'), ('WARNING', 'orders', '[X] 0 of 0 rows'))"
)
def h6_run_messages(spark, folder):
    """The log of a run: every attempt, failure and reconciled table as a line."""
    lines = _run_with_failure(spark, folder).messages(reconciled=True)
    return lines.select("level", "table_name", "message")


@check(
    "WITH t AS (SELECT CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS kind, event_id FROM events)"
    " SELECT kind, CAST(event_id AS VARCHAR) AS event_id FROM t"
    " QUALIFY row_number() OVER (PARTITION BY lower(kind) ORDER BY event_id DESC) = 1"
)
def g2_copy_case_insensitive(spark, folder):
    """A copy into a destination whose text keys do not tell cases apart."""
    kind = F.col("event_type")
    events = table(spark, folder, "events").select(
        F.when(F.col("event_id") % 2 == 0, F.upper(kind)).otherwise(kind).alias("kind"), "event_id"
    )
    job = TableJob("events", events, ("kind",), ("event_id",), collation="UNICODE_CI")
    return spark.read.parquet(run_table(job, new_folder(spark, "copy")).location)
