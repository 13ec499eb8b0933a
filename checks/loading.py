"""Upserts, appends, refused rows, byte batches and registry loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.data import SQL_DIRTY_ORDERS, dirty_orders, table
from tablewharf.operators import batches, chunks, quality, upsert
from tablewharf.sinks.registry import registry_table
from tablewharf.sources import records

_SQL_LATEST_EVENTS = (
    "SELECT * FROM events QUALIFY row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)


@check(_SQL_LATEST_EVENTS)
def f1_latest_per_key(spark, folder):
    return upsert.latest_per_key(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


@check(
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,"
    " l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"
)
def f1_composite_key(spark, folder):
    """Ties on the order column are settled by the other columns, in table order."""
    return upsert.latest_per_key(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@check(
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,"
    " l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"
)
def f1_split_upsert(spark, folder):
    """As the composite key, but rows whose key occurs once are not shuffled."""
    return upsert.split_upsert(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@check("SELECT DISTINCT quality, toxic FROM labels")
def f1_key_only_table(spark, folder):
    labels = table(spark, folder, "labels").select("quality", "toxic")
    return upsert.latest_per_key(labels, ["quality", "toxic"])


@check(
    "WITH t AS (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN upper(event_type)"
    " ELSE event_type END AS event_type) FROM events)"
    " SELECT * FROM t QUALIFY row_number() OVER"
    " (PARTITION BY lower(event_type) ORDER BY ts DESC, event_id DESC) = 1"
)
def f1_case_insensitive_key(spark, folder):
    kind = F.col("event_type")
    mixed = table(spark, folder, "events").withColumn(
        "event_type", F.when(F.col("event_id") % 2 == 0, F.upper(kind)).otherwise(kind)
    )
    return upsert.latest_per_key(mixed, ["event_type"], ["ts", "event_id"], collation="UNICODE_CI")


@check(
    "SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS record_id, CASE WHEN c_custkey % 3 = 0"
    " THEN '12345678.9' WHEN c_custkey % 3 = 1 THEN '0.0001' ELSE '-0.5' END AS amount,"
    " CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '0' END AS flag FROM customer"
)
def f10_registry_text_id(spark, folder):
    """Ids count in the order of a text; numbers and booleans read as in tables."""
    key = F.col("c_custkey")
    found = table(spark, folder, "customer").select(
        F.col("c_name").alias("record_id"),
        F.when(key % 3 == 0, 12345678.9).when(key % 3 == 1, 0.0001).otherwise(-0.5).alias("amount"),
        (key % 2 == 0).alias("flag"),
    )
    return registry_table(found, ["id", "record_id", "amount", "flag"], dense_by="record_id")


@check(
    "WITH t AS (SELECT CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id, ts, event_id, value FROM events),"
    " w AS (SELECT user_id, ts, event_id, value + 1 AS value FROM t WHERE event_id % 2 = 0 QUALIFY"
    " row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"
    " SELECT * FROM w UNION ALL SELECT * FROM t WHERE NOT EXISTS"
    " (SELECT 1 FROM w WHERE w.user_id IS NOT DISTINCT FROM t.user_id)"
)
def f1_merge_null_key(spark, folder):
    """Rows without a key are one key: a change replaces them like any other."""
    events = table(spark, folder, "events").select(
        F.when(F.col("event_id") % 3 > 0, F.col("user_id")).alias("user_id"), "ts", "event_id", "value"
    )
    changed = events.where("event_id % 2 = 0").withColumn("value", F.col("value") + 1)
    changed = upsert.latest_per_key(changed, ["user_id"], ["ts", "event_id"])
    return upsert.merge_by_key(events, changed, ["user_id"])


def _order_changes(orders):
    return orders.withColumns(
        {"o_orderkey": F.col("o_orderkey") + 5000, "o_totalprice": F.col("o_totalprice") + 1}
    )


@check(
    "WITH c AS (SELECT * REPLACE (o_orderkey + 5000 AS o_orderkey, o_totalprice + 1 AS o_totalprice)"
    " FROM orders) SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c)"
    " UNION ALL SELECT * FROM c"
)
def f1_merge_replaces(spark, folder):
    """Changes replace rows with their key and add the others."""
    orders = table(spark, folder, "orders")
    return upsert.merge_by_key(orders, _order_changes(orders), ["o_orderkey"])


@check(_SQL_LATEST_EVENTS)
def f1_merge_keeps_newer(spark, folder):
    """Merging an older half into a newer snapshot gives the same as one upsert of both."""
    events = table(spark, folder, "events")
    new = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    order = ["ts", "event_id"]
    snapshot = upsert.latest_per_key(events.where(new), ["user_id"], order)
    return upsert.merge_by_key(snapshot, events.where(~new), ["user_id"], order)


@check("SELECT * FROM labels UNION ALL SELECT * FROM labels")
def f2_append(spark, folder):
    labels = table(spark, folder, "labels")
    return upsert.append(labels, labels)


@check("SELECT * FROM documents WHERE strlen(text) <= 8192")
def f4_accepted_rows(spark, folder):
    documents = table(spark, folder, "documents")
    return quality.split_rows(documents, ["doc_id"], max_text_bytes=8192)[0]


@check(
    "SELECT doc_id, strlen(text) AS bytes, 'text exceeds 8192 bytes' AS refusal_reason"
    " FROM documents WHERE strlen(text) > 8192"
)
def f4_refused_rows(spark, folder):
    documents = table(spark, folder, "documents")
    refused = quality.split_rows(documents, ["doc_id"], max_text_bytes=8192)[1]
    return refused.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("bytes"), "refusal_reason"
    )


@check(
    "WITH t AS (SELECT *, CASE WHEN lower(o_orderstatus) IN ('nan', 'inf', '-inf', 'null', 'none')"
    " THEN 'key o_orderstatus is null' WHEN length(o_orderpriority) > 6"
    " THEN 'key o_orderpriority exceeds 6 characters' END AS refusal_reason"
    f" FROM ({SQL_DIRTY_ORDERS})) SELECT refusal_reason, count(*) AS refused_rows FROM t"
    " WHERE refusal_reason IS NOT NULL GROUP BY 1"
)
def f4_refused_keys(spark, folder):
    refused = quality.split_rows(
        dirty_orders(spark, folder), ["o_orderstatus", "o_orderpriority"], max_key_chars=6
    )[1]
    return refused.groupBy("refusal_reason").agg(F.count(F.lit(1)).alias("refused_rows"))


@check(
    "SELECT doc_id, lang, CAST(running AS BIGINT) AS running_bytes,"
    " CAST(running // 65536 AS BIGINT) AS batch_id FROM"
    " (SELECT doc_id, lang, sum(strlen(text)) OVER (PARTITION BY lang ORDER BY doc_id) AS running"
    " FROM documents)"
)
def f5_byte_batches(spark, folder):
    documents = table(spark, folder, "documents")
    batches = chunks.with_byte_batches(documents, ["text"], "doc_id", 65536, ["lang"])
    return batches.select("doc_id", "lang", "running_bytes", "batch_id")


@check(
    "SELECT CAST(running // 1000000 AS BIGINT) AS batch_id, count(*) AS rows_in_batch,"
    " min(page_id) AS first_page, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT page_id,"
    " strlen(url) + strlen(html) AS bytes, sum(strlen(url) + strlen(html)) OVER (ORDER BY page_id)"
    " AS running FROM pages) GROUP BY 1"
)
def f5_byte_batch_summary(spark, folder):
    pages = table(spark, folder, "pages")
    batches = chunks.with_byte_batches(pages, ["url", "html"], "page_id", 1_000_000)
    size = F.octet_length("url").cast("bigint") + F.octet_length("html")
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows_in_batch"),
        F.min("page_id").alias("first_page"),
        F.sum(size).alias("bytes"),
    )


@check(
    "WITH RECURSIVE s AS (SELECT doc_id, lang, strlen(text) AS n, row_number() OVER (ORDER BY lang, doc_id) AS i FROM documents),"
    " b AS (SELECT i, doc_id, lang, n AS held, CAST(0 AS BIGINT) AS batch_id FROM s WHERE i = 1 UNION ALL"
    " SELECT s.i, s.doc_id, s.lang, CASE WHEN s.lang = b.lang AND b.held + s.n <= 65536 THEN b.held + s.n ELSE s.n END,"
    " b.batch_id + CASE WHEN s.lang = b.lang AND b.held + s.n <= 65536 THEN 0 ELSE 1 END FROM b JOIN s ON s.i = b.i + 1)"
    " SELECT doc_id, batch_id FROM b"
)
def f5_bounded_batches(spark, folder):
    """Each batch takes rows of one language, in order, as long as they stay within the limit."""
    documents = table(spark, folder, "documents")
    size = batches.byte_size(["text"])
    found = batches.with_bounded_batches(documents, size, "doc_id", 65536, ["lang"])
    return found.select("doc_id", "batch_id")


_REGISTRY = ["id", "record_id", "hn", "postcode", "event_id", "event_type", "k", "visit_date", "loaded_at"]


@check(
    "SELECT row_number() OVER (ORDER BY event_id) AS id, CAST(user_id AS VARCHAR) AS record_id,"
    " CAST(NULL AS VARCHAR) AS hn, CAST(NULL AS VARCHAR) AS postcode,"
    " CAST(event_id AS VARCHAR) AS event_id, event_type, json_extract_string(props, '$.k') AS k,"
    " strftime(ts, '%Y-%m-%d') AS visit_date FROM events"
)
def f10_registry_table(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("record_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("visit_date"),
        F.col("value").alias("not_in_registry"),
        "props",
    )
    parsed = records.parse_records(events, "props", "k bigint")
    return registry_table(parsed, _REGISTRY, dense_by="event_id")
