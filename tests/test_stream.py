"""Streams: many small batches give what one batch would."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewharf.operators.upsert import latest_per_key
from tablewharf.sinks.workspace import new_folder
from tablewharf.streaming import incremental, progress

KEY, ORDER = ["user_id"], ["ts", "event_id"]


@pytest.fixture
def parts(spark, data):
    """The events in four files, in no order of time."""
    events = spark.read.parquet(f"{data}/events.parquet")
    folder = new_folder(spark, "incoming")
    events.repartition(4, "event_id").write.parquet(folder)
    return events, folder


def rows(df):
    return sorted(map(tuple, df.select("user_id", "event_id", "ts", "value").collect()))


def run(spark, events, incoming, target):
    stream = incremental.file_stream(spark, incoming, events.schema, files_per_batch=1)
    incremental.upsert_stream(stream, target, KEY, ORDER)


def test_stream_equals_batch(spark, parts):
    events, incoming = parts
    target = new_folder(spark, "stream")
    run(spark, events, incoming, target)
    assert incremental.changes(spark, target).select("batch").distinct().count() == 4
    result = incremental.current_table(spark, target, KEY, ORDER)
    assert rows(result) == rows(latest_per_key(events, KEY, ORDER))


def test_a_later_run_takes_only_new_files(spark, parts):
    events, incoming = parts
    target = new_folder(spark, "stream")
    run(spark, events, incoming, target)
    run(spark, events, incoming, target)
    assert incremental.changes(spark, target).select("batch").distinct().count() == 4
    newer = events.orderBy("event_id").limit(3).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 YEAR"))
    newer.coalesce(1).write.mode("append").parquet(incoming)
    run(spark, events, incoming, target)
    expected = latest_per_key(events.unionByName(newer), KEY, ORDER)
    assert rows(incremental.current_table(spark, target, KEY, ORDER)) == rows(expected)


def test_compaction_keeps_the_table_and_leaves_later_batches(spark, parts):
    events, incoming = parts
    target = new_folder(spark, "stream")
    run(spark, events, incoming, target)
    folder, last = incremental.compact(spark, target, "1", KEY, ORDER)
    base = spark.read.parquet(folder)
    older = events.limit(5).withColumn("ts", F.col("ts") - F.expr("INTERVAL 9 YEARS"))
    newer = events.limit(2).withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 YEARS"))
    older.unionByName(newer).coalesce(1).write.mode("append").parquet(incoming)
    run(spark, events, incoming, target)
    now = incremental.current_table(spark, target, KEY, ORDER, base, after_batch=last)
    everything = events.unionByName(older).unionByName(newer)
    assert rows(now) == rows(latest_per_key(everything, KEY, ORDER))
    second, end = incremental.compact(spark, target, "2", KEY, ORDER, base, last)
    assert end == last + 1
    assert rows(spark.read.parquet(second)) == rows(now)
    again = incremental.compact(spark, target, "3", KEY, ORDER, spark.read.parquet(second), end)
    assert again[1] == end and rows(spark.read.parquet(again[0])) == rows(now)


def test_writing_a_batch_again_changes_nothing(spark, parts):
    events, incoming = parts
    target = new_folder(spark, "stream")
    run(spark, events, incoming, target)
    before = rows(incremental.current_table(spark, target, KEY, ORDER))
    replay = incremental.changes(spark, target).where("batch = 2").drop("batch").cache()
    assert replay.count()
    replay.write.mode("overwrite").parquet(f"{target}/changes/batch={2:010d}")
    assert rows(incremental.current_table(spark, target, KEY, ORDER)) == before


def test_a_table_without_changes_is_its_base(spark):
    base = spark.range(3)
    empty = new_folder(spark, "stream")
    assert incremental.current_table(spark, empty, ["id"], base=base).count() == 3
    with pytest.raises(AnalysisException):
        incremental.current_table(spark, empty, ["id"])


def test_refused_rows_of_a_stream_are_set_aside(spark):
    incoming, target = new_folder(spark, "incoming"), new_folder(spark, "stream")
    df = spark.createDataFrame([("a ", 1), ("a", 2), ("null", 3), (None, 4), ("b", None)], "k string, v int")
    df.coalesce(1).write.parquet(incoming)
    incremental.upsert_stream(incremental.file_stream(spark, incoming, df.schema), target, ["k"], ["v"])
    table = incremental.current_table(spark, target, ["k"], ["v"])
    assert sorted(map(tuple, table.collect())) == [("a", 2), ("b", 0)]
    refused = spark.read.parquet(f"{target}/refused")
    assert {(r.v, r.refusal_reason) for r in refused.collect()} == {(3, "key k is null"), (4, "key k is null")}


def test_progress_follows_the_stream(spark, parts):
    events, incoming = parts
    target = new_folder(spark, "progress")
    stream = incremental.file_stream(spark, incoming, events.schema, files_per_batch=1)
    progress.progress_stream(stream, target, ["event_type"], "ts")
    seen = {tuple(r) for r in progress.latest_progress(spark, target).collect()}
    expected = events.groupBy("event_type").agg(F.count(F.lit(1)), F.max("ts"))
    assert seen == {tuple(r) for r in expected.collect()}
