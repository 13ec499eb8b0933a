"""The bucketed base: only touched buckets are rewritten, and a crash changes nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewharf.operators.upsert import latest_per_key
from tablewharf.sinks.workspace import new_folder
from tablewharf.streaming import incremental
from tablewharf.streaming.buckets import BucketedTable

KEY, ORDER = ("user_id",), ("ts", "event_id")


@pytest.fixture
def events(spark, data):
    return spark.read.parquet(f"{data}/events.parquet")


@pytest.fixture
def kept(spark):
    return BucketedTable(spark, new_folder(spark, "stream"), KEY, ORDER, buckets=8)


def arrive(spark, kept, incoming, rows):
    rows.coalesce(1).write.mode("append").parquet(incoming)
    incremental.upsert_stream(incremental.file_stream(spark, incoming, rows.schema), kept.folder, KEY, ORDER)


def rows(df):
    return sorted(map(tuple, df.select("user_id", "event_id", "ts", "value").collect()))


def files(spark, kept, state):
    """The data files of each bucket."""
    return {b: sorted(spark.read.parquet(f"{kept.folder}/{f}").inputFiles()) for b, f in state.folders.items()}


def test_only_touched_buckets_are_rewritten(spark, events, kept):
    incoming = new_folder(spark, "incoming")
    assert kept.current() is None and kept.compact().version == 0
    arrive(spark, kept, incoming, events)
    first = kept.compact()
    before = files(spark, kept, first)
    assert set(first.rows.values()) != {0} and sum(first.rows.values()) == events.select("user_id").distinct().count()
    newer = events.where("user_id in (3, 4)").limit(2).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 YEAR"))
    arrive(spark, kept, incoming, newer)
    expected = rows(latest_per_key(events.unionByName(newer), KEY, ORDER))
    assert rows(kept.current()) == expected
    second = kept.compact()
    after = files(spark, kept, second)
    touched = {r[0] for r in newer.select(kept.bucket()).distinct().collect()}
    assert touched and touched < set(before)
    assert {b for b in before if before[b] != after[b]} == touched
    assert rows(kept.current()) == expected and second.last_batch > first.last_batch
    assert rows(kept.current(version=1)) == rows(latest_per_key(events, KEY, ORDER))
    assert kept.compact() == second  # nothing new


@pytest.mark.parametrize("moment", ["write", "manifest"])
def test_a_crash_leaves_the_old_state(spark, events, kept, monkeypatch, moment):
    incoming = new_folder(spark, "incoming")
    arrive(spark, kept, incoming, events.where("event_id % 2 = 0"))
    first = kept.compact()
    arrive(spark, kept, incoming, events.where("event_id % 2 = 1"))
    expected = rows(latest_per_key(events, KEY, ORDER))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if moment == "write":
            broken.setattr(BucketedTable, "bucket", lambda self: F.raise_error(F.lit("lost")).cast("int"))
        else:
            broken.setattr(BucketedTable, "_commit", crash)
        with pytest.raises(Exception, match="lost"):
            kept.compact()
    assert kept.state() == first
    assert rows(kept.current()) == expected
    assert kept.compact().version == first.version + 1
    assert rows(kept.current()) == expected


def test_late_rows_do_not_replace_newer_ones(spark, events, kept):
    incoming = new_folder(spark, "incoming")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    arrive(spark, kept, incoming, events.where(F.col("ts") >= half))
    kept.compact()
    arrive(spark, kept, incoming, events.where(F.col("ts") < half))
    assert rows(kept.current()) == rows(latest_per_key(events, KEY, ORDER))
    kept.compact()
    assert rows(kept.current()) == rows(latest_per_key(events, KEY, ORDER))


def test_conflicts_and_other_bucket_counts_are_noticed(spark, events, kept):
    arrive(spark, kept, new_folder(spark, "incoming"), events)
    state = kept.compact()
    with pytest.raises(ValueError, match="8 buckets"):
        BucketedTable(spark, kept.folder, KEY, ORDER, buckets=9).state()
    with pytest.raises(RuntimeError, match="two compactions"):
        kept._commit(state.version, state.last_batch, {})


def test_keyless_streams(spark):
    """An empty key is refused; distinct streams keep each row once, NULLs and padding included, over batches and runs."""
    target, incoming = new_folder(spark, "stream"), new_folder(spark, "incoming")
    values = [(1, "a"), (1, "a "), (None, None), (1, "a"), (None, None), (2, "b")]
    frame = spark.createDataFrame(values, "n int, t string")
    frame.repartition(3).write.parquet(incoming)

    def stream():
        return incremental.file_stream(spark, incoming, frame.schema, files_per_batch=1)

    with pytest.raises(ValueError, match="distinct_stream"):
        incremental.upsert_stream(stream(), target, ())
    incremental.distinct_stream(stream(), target, fill_numeric=None)
    frame.union(spark.createDataFrame([(3, "c")], frame.schema)).coalesce(1).write.mode("append").parquet(incoming)
    incremental.distinct_stream(stream(), target, fill_numeric=None)
    found = sorted(map(tuple, incremental.distinct_table(spark, target).collect()), key=repr)
    assert found == sorted([(1, "a"), (1, "a"), (None, None), (2, "b"), (3, "c")], key=repr)
