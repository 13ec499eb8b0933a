"""Whole copies: counts that add up, retries, snapshots and registry loads."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewharf.__main__ import main
from tablewharf.operators import ledger as reports
from tablewharf.plans import run
from tablewharf.plans.table_job import TableJob, TableResult, run_table
from tablewharf.sinks import jdbc, snapshots
from tablewharf.sinks.registry import registry_table
from tablewharf.sinks.workspace import new_folder, shared_folder


@pytest.fixture
def people(spark):
    rows = [
        (1, " ann ", 1.0, datetime(2024, 1, 1, 0, 0, 0, 1)),
        (1, " ann ", 1.0, datetime(2024, 1, 1, 0, 0, 0, 1)),
        (1, "anna", 2.0, datetime(2024, 1, 1, 0, 0, 0, 2)),
        (2, "null", float("nan"), None),
        (3, "x" * 50, None, None),
        (None, "zero", 3.0, None),
    ]
    return spark.createDataFrame(rows, "id int, name string, score double, seen timestamp_ntz")


def loaded(spark, result):
    return sorted(map(tuple, spark.read.parquet(result.location).collect()))


def test_upsert_copy_orders_by_typed_values(spark, people):
    """Times differ below the second that the text keeps; the later row still wins."""
    job = TableJob("people", people, ("id",), ("seen",), count_duplicates=True, limits={"max_text_bytes": 20})
    result = run_table(job, new_folder(spark, "t"))
    assert loaded(spark, result) == [
        ("1", "anna", "2.0", "2024-01-01 00:00:00"), ("2", None, "0.0", None),
    ]
    assert (result.src_rows, result.dst_rows, result.duplicates, result.superseded, result.quarantined) == (6, 2, 1, 1, 2)
    assert result.nulls == {"seen": 1}  # 'null' is still text when NULLs are counted
    refused = {(r.id, r.refusal_reason) for r in spark.read.parquet(result.quarantine).collect()}
    assert refused == {("3", "name exceeds 20 bytes"), (None, "key id is null")}


def test_copies_count_as_superseded_when_not_told_apart(spark, people):
    result = run_table(TableJob("people", people, ("id",), ("seen",)), new_folder(spark, "t"))
    assert (result.duplicates, result.superseded, result.quarantined) == (0, 2, 1)


def test_rows_without_a_key_never_become_key_zero(spark):
    """NULL and NaN keys are refused, whatever fills other columns; what is set aside is the source as it was."""
    df = spark.createDataFrame([(0, 1, " x "), (None, 2, "null"), (None, None, None)], "id int, v int, s string")
    for unique in (None, False):
        result = run_table(TableJob("t", df, ("id",), key_is_unique=unique), new_folder(spark, "t"))
        assert loaded(spark, result) == [("0", "1", "x")]
        assert (result.quarantined, result.superseded) == (2, 0)
        bad = sorted(map(tuple, spark.read.parquet(result.quarantine).collect()), key=repr)
        assert bad == [(None, "2", "null", "key id is null"), (None, None, None, "key id is null")]
    floats = spark.createDataFrame([(0.0, "a"), (float("nan"), "b"), (None, "c")], "k double, s string")
    result = run_table(TableJob("t", floats, ("k",)), new_folder(spark, "t"))
    assert loaded(spark, result) == [("0.0", "a")] and result.quarantined == 2


def test_quarantine_keeps_source_values(spark):
    df = spark.createDataFrame([("null", " pad "), (" x ", "y" * 30), ("ok", "v")], "k string, s string")
    result = run_table(TableJob("t", df, ("k",), limits={"max_text_bytes": 20}), new_folder(spark, "t"))
    bad = {tuple(r) for r in spark.read.parquet(result.quarantine).collect()}
    assert bad == {("null", " pad ", "key k is null"), (" x ", "y" * 30, "s exceeds 20 bytes")}


def test_copy_without_key_keeps_padded_copies(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a ",)], "s string")
    result = run_table(TableJob("t", df), new_folder(spark, "t"))
    assert loaded(spark, result) == [("a",), ("a",)] and result.nulls == {}
    assert (result.duplicates, result.superseded) == (1, 0)


def test_key_is_checked_as_the_destination_sees_it(spark):
    """'a' and 'a ' differ in the source, but not after cleaning; NULL never becomes the key 0."""
    texts = spark.createDataFrame([("a", 1), ("a ", 2)], "k string, v int")
    assert run_table(TableJob("t", texts, ("k",), ("v",)), new_folder(spark, "t")).dst_rows == 1
    numbers = spark.createDataFrame([(0, 1), (None, 2)], "k int, v int")
    assert loaded(spark, run_table(TableJob("t", numbers, ("k",), ("v",)), new_folder(spark, "t"))) == [("0", "1")]
    times = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 1), 1), (datetime(2024, 1, 1, 0, 0, 0, 2), 2)], "k timestamp_ntz, v int"
    )
    assert run_table(TableJob("t", times, ("k",), ("v",)), new_folder(spark, "t")).dst_rows == 1


def test_proven_key_needs_no_shuffle(spark):
    from tablewharf.plans.table_job import loaded_rows

    job = TableJob("t", spark.range(100), ("id",), key_is_unique=True)
    plan = loaded_rows(job, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_nested_and_oddly_named_columns(spark):
    df = spark.sql(
        "SELECT 1 AS `a.b`, map('k', 1) AS m, array(1.5D) AS `x``y`, 2 AS refusal_reason"
        " UNION ALL SELECT 1, map('k', 2), array(2.5D), 3"
    )
    result = run_table(TableJob("t", df, ("a.b",), ("refusal_reason",)), new_folder(spark, "t"))
    rows = spark.read.parquet(result.location)
    assert rows.columns == ["a.b", "m", "x`y", "refusal_reason"]
    assert [tuple(r) for r in rows.collect()] == [("1", '{"k":2}', "[2.5]", "3")]


def test_nulls_of_refused_rows_do_not_count(spark):
    df = spark.createDataFrame([("k", None, "x"), ("l", None, "y"), ("null", None, None)], "k string, v string, w string")
    for unique, expected in ((True, {"v": 2}), (False, {"v": 2})):
        job = TableJob("t", df, ("k",), key_is_unique=unique)
        assert run_table(job, new_folder(spark, "t")).nulls == expected


def test_all_rows_refused(spark):
    df = spark.createDataFrame([("null", 1), ("none", 2)], "k string, v int")
    result = run_table(TableJob("t", df, ("k",)), new_folder(spark, "t"))
    assert (result.src_rows, result.dst_rows, result.quarantined, result.duplicates) == (2, 0, 2, 0)


def test_run_keeps_going_and_records_every_attempt(spark):
    calls = []

    def runner(job, folder):
        calls.append(job.name)
        if job.name == "broken" or calls.count("flaky") == 1 and job.name == "flaky":
            raise RuntimeError("no such table " + "x" * 500)
        return run_table(job, folder)

    jobs = [TableJob(n, spark.range(5)) for n in ("broken", "flaky", "good")]
    jobs.append(TableJob("nothing", spark.range(0)))

    def registry_down():
        raise OSError("registry unreachable")

    book = run.copy_tables(
        spark, jobs, new_folder(spark, "run"), before=registry_down, retry_seconds=0, runner=runner
    )
    rows = book.rows()
    latest = {r.table_name: r for r in reports.current_status(rows).collect()}
    assert {t: r.status for t, r in latest.items()} == {
        "broken": "failed", "flaky": "completed", "good": "completed", "nothing": "empty",
    }
    assert latest["broken"].attempt == 3 and len(latest["broken"].error) > 500
    assert latest["flaky"].attempt == 2 and latest["flaky"].dst_rows == 5
    retries = rows.where("table_name = 'broken' AND status = 'retrying'")
    assert {r.error for r in retries.collect()} == {"trying again, 2 of 3", "trying again, 3 of 3"}
    view = {r.table_name: r.batch_rows for r in reports.progress_view(reports.current_status(rows)).collect()}
    assert view == {"broken": 0, "flaky": 1000, "good": 1000, "nothing": 0}


def test_tables_at_once_publish_into_one_snapshot(spark):
    started = datetime(2031, 5, 6, 7, 8, 9)
    namespace = snapshots.run_namespace(spark, "at_once_{YYYY}_{MM}_{DD}", started)
    jobs = [TableJob(f"t{i}", spark.range(i + 1)) for i in range(5)]
    run.copy_tables(spark, jobs, new_folder(spark, "run"), namespace, at_once=4)
    assert [spark.table(f"{namespace}.t{i}").count() for i in range(5)] == [1, 2, 3, 4, 5]
    assert spark.table(f"{namespace}.t0").schema.simpleString() == "struct<id:string>"


def test_command_line(spark, capsys):
    base = new_folder(spark, "cli")
    source = snapshots.run_namespace(spark, "cli_source_1", datetime(2024, 1, 1), dated=False, folder=base)
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, " c", 1)], "k int, v string, o int")
    for name in ("visits", "audit", "wards"):
        snapshots.full_refresh(rows, source, name, f"{base}/source/{name}")
    common = ["--source", "LATEST:cli_source_*", "--folder", base, "--static", "--destination", "cli_copy"]
    code = main(
        [*common, "--exclude", "audit", "--keys", '{"visits": ["k"]}', "--order-by", '{"visits": ["o"]}'], spark
    )
    assert code == 0 and "cli_copy" in capsys.readouterr().out
    copied = [tuple(r) for r in spark.table("cli_copy.visits").orderBy("k").collect()]
    assert copied == [("1", "b", "2"), ("2", "c", "1")]
    assert spark.table("cli_copy.wards").count() == 3
    assert not spark.catalog.tableExists("cli_copy.audit")
    before = spark.sql("DESCRIBE EXTENDED cli_copy.wards").where("col_name = 'Location'").first()[1]
    assert main([*common, "--include", "wards"], spark) == 0
    after = spark.sql("DESCRIBE EXTENDED cli_copy.wards").where("col_name = 'Location'").first()[1]
    assert before != after and spark.read.parquet(before).count() == 3
    assert spark.table("cli_copy.wards").count() == 3
    assert main([*common, "--include", "none_such"], spark) == 0
    assert "no tables" in capsys.readouterr().out


def test_refresh_swaps_the_version_and_its_columns(spark):
    namespace = snapshots.run_namespace(spark, "swap", datetime(2024, 1, 1), dated=False)
    base = new_folder(spark, "swap")
    first = snapshots.full_refresh(spark.range(3), namespace, "t", base)
    kept = first.inputFiles()
    assert snapshots.full_refresh(spark.range(5), namespace, "t", base).count() == 5
    assert spark.read.parquet(*kept).count() == 3  # the old version is still there
    wider = spark.range(2).withColumn("note", F.lit("x"))
    assert snapshots.full_refresh(wider, namespace, "t", base).columns == ["id", "note"]


def test_failing_refresh_leaves_the_old_version(spark):
    namespace = snapshots.run_namespace(spark, "swap_fails", datetime(2024, 1, 1), dated=False)
    base = new_folder(spark, "swap")
    snapshots.full_refresh(spark.range(3), namespace, "t", base)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        snapshots.full_refresh(broken, namespace, "t", base)
    assert spark.table("swap_fails.t").count() == 3


def test_lost_rows_fail_the_copy(spark, monkeypatch):
    from tablewharf.plans import table_job

    written = table_job.write_version
    monkeypatch.setattr(table_job, "write_version", lambda df, folder: written(df.limit(1), folder))
    job = TableJob("t", spark.range(3), ("id",), key_is_unique=True)
    with pytest.raises(RuntimeError, match="do not add up"):
        run_table(job, new_folder(spark, "lost"))


def test_wide_registry_table(spark):
    columns = ["id", "record_id", "hn", "postcode"] + [f"field_{i:03d}" for i in range(369)]
    fields = columns[1:] + ["not_in_table", "loaded_at"]
    row = spark.range(50).select(
        *[F.concat(F.lit(f"{c}:"), F.col("id")).alias(c) for c in fields if c != "hn"], F.lit("").alias("hn")
    )
    table = registry_table(row, columns)
    assert table.columns == columns and len(columns) == 373
    assert {f.dataType.simpleString() for f in table.schema.fields[1:]} == {"string"}
    rows = table.collect()
    assert len({r.id for r in rows}) == 50 and min(r.id for r in rows) == 1
    assert all(r.hn == "" and r.field_000.startswith("field_000:") for r in rows)
    missing = registry_table(row.drop("hn"), columns)
    assert {r.hn for r in missing.select("hn").collect()} == {None}


def test_text_columns_of_a_database_table(spark):
    df = spark.createDataFrame([("1", "x")], "k string, v string")
    assert jdbc.text_column_types(df, ["k"]) == "`k` VARCHAR(255)"


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert TableResult(src_rows=0).dst_rows == 0


def test_registry_step_is_part_of_the_run(spark, capsys, tmp_path):
    """Its outcome is in the ledger and the messages; its failure stops no table."""
    base = new_folder(spark, "cli")
    source = snapshots.run_namespace(spark, "registry_source", datetime(2024, 1, 1), dated=False, folder=base)
    rows = spark.createDataFrame([("A", 1), ("a", 2), ("b", 1)], "k string, o int")
    snapshots.full_refresh(rows, source, "visits", f"{base}/source/visits")
    records = tmp_path / "records.json"
    records.write_text('{"record_id": "7", "hn": "x"}\n{"record_id": "8", "other": 1}\n')
    common = ["--source", "registry_source", "--folder", base, "--static", "--destination", "registry_copy"]
    common += ["--keys", '{"visits": ["k"]}', "--order-by", '{"visits": ["o"]}', "--collation", "UNICODE_CI"]
    registry = ["--registry-records", str(records), "--registry-columns", "id, record_id, hn", "--registry-table", "reg"]
    assert main([*common, *registry], spark) == 0
    assert "[OK] visits 2 of 2" in capsys.readouterr().out
    assert sorted((r.record_id, r.hn) for r in spark.table("registry_copy.reg").collect()) == [("7", "x"), ("8", None)]
    assert sorted(map(tuple, spark.table("registry_copy.visits").collect())) == [("a", "2"), ("b", "1")]
    registry[1] = str(tmp_path / "missing.json")
    assert main([*common, *registry], spark) == 0
    assert "ERROR registry failed:" in capsys.readouterr().out


def test_reconciliation_sees_rows_that_went_missing(spark):
    """A table that lost rows after it was loaded no longer matches what the run says."""
    book = run.copy_tables(spark, [TableJob(n, spark.range(5)) for n in ("good", "bad")], new_folder(spark, "run"), reconciled=True)
    assert {r.table_name: r.mark for r in book.reconciliation().collect()} == {"good": "[OK]", "bad": "[OK]"}
    location = book.final().where("table_name = 'bad'").first()["location"]
    snapshots.write_version(spark.range(4).selectExpr("cast(id as string) id"), location)
    book.reconcile()
    assert {r.table_name: (r.dst_rows, r.mark) for r in book.reconciliation().collect()} == {"good": (5, "[OK]"), "bad": (4, "[!]")}
    lines = {(r.level, r.table_name, r.message) for r in book.messages(reconciled=True).where("message like '[%'").collect()}
    assert lines == {("INFO", "good", "[OK] 5 of 5 rows"), ("WARNING", "bad", "[!] 4 of 5 rows")}
