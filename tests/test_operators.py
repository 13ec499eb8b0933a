"""Key, chunk, selection and ledger operators against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewharf.operators import chunks, ledger, quality, selection, upsert
from tablewharf.sources import catalog, files, jdbc, records


def test_latest_per_key_breaks_ties_the_same_way_however_rows_are_spread(spark):
    rows = [(k, o, v) for k in "ab" for o in (1, 2, 2, None) for v in ("x", "y")]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, o int, v string").repartition(seed + 1)
        results.add(tuple(sorted(map(tuple, upsert.latest_per_key(df, ["k"], ["o"]).collect()))))
    assert results == {(("a", 2, "y"), ("b", 2, "y"))}


def test_latest_per_key_without_values_inserts_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, j string")
    assert sorted(map(tuple, upsert.latest_per_key(df, ["k", "j"]).collect())) == [(1, "a"), (2, "a")]


def test_latest_per_key_counts_what_it_merges(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "k int, v int")
    counted = upsert.latest_per_key(df, ["k"], ["v"], count_as="n")
    assert sorted(map(tuple, counted.collect())) == [(1, 6, 2), (2, 7, 1)]


@pytest.mark.parametrize(("collation", "rows"), [(None, 3), ("UNICODE_CI", 2), ("UNICODE_CI_AI", 1)])
def test_key_collations(spark, collation, rows):
    df = spark.createDataFrame([("a", 1), ("A", 2), ("á", 3)], "k string, v int")
    assert upsert.latest_per_key(df, ["k"], ["v"], collation=collation).count() == rows


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(30000).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    plan = upsert.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = next(i for i, line in enumerate(lines) if "partial_max" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
    assert exchange < partial  # plans print from the result down


def test_merge_replaces_adds_and_keeps(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", 5)], "k int, v string, o int")
    change = spark.createDataFrame([(2, "new", 9), (3, "late", 1), (4, "new", 1)], "k int, v string, o int")
    plain = upsert.merge_by_key(target, change, ["k"])
    assert {(r.k, r.v) for r in plain.collect()} == {(1, "old"), (2, "new"), (3, "late"), (4, "new")}
    ordered = upsert.merge_by_key(target, change, ["k"], ["o"])
    assert {(r.k, r.v) for r in ordered.collect()} == {(1, "old"), (2, "new"), (3, "old"), (4, "new")}


def test_refused_rows_carry_their_reason(spark):
    df = spark.createDataFrame(
        [("k", "é" * 4), (None, "x"), ("NULL", "x"), ("long", "x"), ("ok", "é" * 5)], "k string, v string"
    )
    good, bad = quality.split_rows(df, ["k"], max_text_bytes=9, max_key_chars=3)
    assert [r.k for r in good.collect()] == ["k"]
    reasons = {(r.k, r.refusal_reason) for r in bad.collect()}
    assert reasons == {
        (None, "key k is null"), ("NULL", "key k is null"),
        ("long", "key k exceeds 3 characters"), ("ok", "v exceeds 9 bytes"),
    }


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert tuple(quality.key_check(df, ["a", "b"]).first()) == (4, 2, 2, False)
    assert tuple(quality.key_check(df.where("a = 1"), ["b"]).first()) == (2, 2, 0, True)
    assert tuple(quality.key_check(df.limit(0), ["a"]).first()) == (0, 0, 0, True)


@pytest.mark.parametrize("keys", [[5], [0, 1, 2], list(range(10)), [-7, -3, 0, 12, 100], [-(2**63), 0, 2**63 - 1]])
@pytest.mark.parametrize("n", [1, 3, 8])
def test_chunks_cover_every_row_once_and_in_order(spark, keys, n):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    manifest = sorted(chunks.chunk_manifest(df, "k", n).collect())
    assert sum(r.rows_in_chunk for r in manifest) == len(keys)
    assert 0 <= manifest[0].chunk and manifest[-1].chunk < n
    for a, b in zip(manifest, manifest[1:]):
        assert a.max_key < b.min_key


def test_rows_without_a_key_have_their_own_chunk(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    assert {r.chunk for r in chunks.chunk_manifest(df, "k", 2).collect()} == {-1, 0, 1}
    with pytest.raises(TypeError):
        chunks.chunk_manifest(spark.createDataFrame([("a",)], "k string"), "k", 2)


def test_pages_agree_with_a_sorted_list(spark):
    keys = random.Random(1).sample(range(5000), 700)
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(5)
    for offset, limit in ((0, 10), (95, 10), (340, 200), (690, 50), (700, 5)):
        page = chunks.read_page(df, "k", offset, limit, rows_per_chunk=100)
        assert [r.k for r in page.collect()] == sorted(keys)[offset : offset + limit]


def test_pages_by_time_do_not_depend_on_the_session_time_zone(spark):
    times = [datetime(2024, 3, 10) + timedelta(minutes=17 * i) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").repartition(3)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        page = chunks.read_page(df, "t", 95, 30, rows_per_chunk=20)
        assert [r.t for r in page.collect()] == times[95:125]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_pages_of_clustered_keys(spark):
    keys = sorted({i * i * i for i in range(-40, 400)} | {10**15, 10**17})
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 3, "k bigint").repartition(3)
    ordered = [None] * 3 + keys
    for offset, limit in ((0, 5), (2, 4), (60, 25), (300, 100), (440, 10)):
        page = chunks.read_page(df, "k", offset, limit, rows_per_chunk=30)
        assert [r.k for r in page.collect()] == ordered[offset : offset + limit]


def test_running_totals_with_a_hot_group_and_null_groups(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.randint(0, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, g string, v int").repartition(6)
    result = chunks.with_running_total(df, F.col("v"), "id", ["g"], rows_per_cell=37)
    totals, expected = defaultdict(int), {}
    for i, g, v in rows:
        totals[g] += v
        expected[i] = totals[g]
    assert {r.id: r.running_total for r in result.collect()} == expected
    whole = chunks.with_running_total(df, F.col("v"), "id", rows_per_cell=50)
    assert max(r.running_total for r in whole.collect()) == sum(v for _, _, v in rows)


def test_clustered_keys_are_cut_until_no_range_is_too_full(spark):
    cluster = list(range(1000, 1400))
    keys = cluster + [5 * 10**6 + i for i in range(30)] + [10**15, 10**15 + 1, 4 * 10**18, -(4 * 10**18)]
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(4)
    cells = chunks.with_cells(df, "k", rows_per_cell=20)
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == len(keys)
    assert [r.k for r in cells.orderBy("cell", "k").collect()] == sorted(keys)
    numbered = chunks.with_dense_id(df, "k", rows_per_cell=20)
    assert sorted((r.id, r.k) for r in numbered.collect()) == list(enumerate(sorted(keys), start=1))


def test_evenly_spread_keys_are_cut_once(spark):
    cells = chunks.with_cells(spark.range(1000), "id", rows_per_cell=100)
    assert cells.schema["cell"].dataType.simpleString() == "struct<level0:bigint>"
    assert "Join" not in cells._jdf.queryExecution().executedPlan().toString()


def test_cells_of_long_rows(spark, monkeypatch):
    """A range holds few bytes, also where few rows have most of them."""
    monkeypatch.setattr(chunks, "CELL_BYTES", 40_000, raising=False)
    df = spark.createDataFrame([(i, "x" * (10_000 if 20 <= i < 40 else 10)) for i in range(60)], "id long, s string")
    cells = chunks.with_cells(df, "id", rows_per_cell=1000)
    held = cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.octet_length("s")).alias("b")).collect()
    assert sum(r.n for r in held) == 60 and max(r.b for r in held) <= 80_000
    nested = df.where("id < 20").select("id", F.array("s").alias("a"), F.struct("s").alias("t"))
    assert chunks.with_cells(nested, "id", rows_per_cell=1000).select("cell").distinct().count() == 1


def test_dense_ids(spark):
    df = spark.createDataFrame([(k * 7,) for k in range(300)], "k int").repartition(4)
    numbered = chunks.with_dense_id(df, "k", rows_per_cell=11)
    assert sorted((r.id, r.k) for r in numbered.collect()) == [(i + 1, i * 7) for i in range(300)]


def test_byte_batches_never_split_a_small_run(spark):
    df = spark.createDataFrame([(i, "x" * 10) for i in range(10)], "id int, s string")
    batches = chunks.with_byte_batches(df, ["s"], "id", 35).orderBy("id").collect()
    assert [r.batch_id for r in batches] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]


@pytest.mark.parametrize(
    ("rows", "tier", "batch"),
    [(0, "tiny", 1000), (999, "tiny", 1000), (1000, "small", 2000), (10_000, "medium", 5000),
     (100_000, "large", 5000), (999_999, "large", 5000), (1_000_000, "huge", 5000)],
)
def test_size_tiers(spark, rows, tier, batch):
    assert chunks.size_tier(rows) == {"tier": tier, "batch_rows": batch}
    row = chunks.with_size_tier(spark.createDataFrame([(rows,)], "total_rows bigint")).first()
    assert (row.tier, row.batch_rows) == (tier, batch)


def test_table_selection(spark):
    tables = spark.createDataFrame([(t, 1) for t in ("a", "b", "c", "ab")], "table_name string, n int")

    def names(*args, **kwargs):
        return {r.table_name for r in selection.select_tables(tables, *args, **kwargs).collect()}

    assert names() == {"a", "b", "c", "ab"}
    assert names(" a , b") == {"a", "b"}
    assert names("a,b", "b") == {"a"}
    assert names("", "c ,") == {"a", "b", "ab"}
    assert names("a*") == set()
    assert names("a*", "ab", globs=True) == {"a"}


def test_field_alignment(spark):
    df = spark.createDataFrame([(1, "", None, [1])], "id int, note string, gone string, tags array<int>")
    target = ["id", "loaded_at", "tags", "note", "absent"]
    aligned = selection.align(df, target)
    assert aligned.columns == ["note", "tags"]
    assert tuple(aligned.first()) == ("", "[1]")
    assert {tuple(r) for r in selection.unmatched_fields(df, target).collect()} == {("id", 1), ("gone", 0)}
    assert selection.unmatched_fields(df.select("note"), target).count() == 0


def test_primary_keys_come_from_the_metadata_join(spark):
    constraints = spark.createDataFrame(
        [("PRIMARY", "s", "t", "PRIMARY KEY"), ("u", "s", "t", "UNIQUE"), ("PRIMARY", "s", "v", "PRIMARY KEY")],
        "constraint_name string, table_schema string, table_name string, constraint_type string",
    )
    usage = spark.createDataFrame(
        [("PRIMARY", "s", "t", "b", 2), ("PRIMARY", "s", "t", "a", 1), ("u", "s", "t", "x", 1), ("PRIMARY", "s", "v", "k", 1)],
        "constraint_name string, table_schema string, table_name string, column_name string, ordinal_position int",
    )
    found = [(r.table_name, r.column_name) for r in catalog.primary_keys(constraints, usage).collect()]
    assert found == [("t", "a"), ("t", "b"), ("v", "k")]


def test_latest_name(spark):
    df = spark.createDataFrame([("b_2024_01",), ("b_2023_12",), ("c_2025_01",)], "name string")
    assert catalog.latest_name(df, "b_*") == "b_2024_01"
    with pytest.raises(ValueError):
        catalog.latest_name(df, "x*")


def test_catalog_lists_base_tables_of_the_latest_namespace(spark, tmp_path):
    for day, tables in (("01", ["t"]), ("02", ["t", "a"])):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS snap_2024_{day} LOCATION '{tmp_path}/{day}'")
        for t in tables:
            spark.sql(f"CREATE TABLE snap_2024_{day}.{t} (x INT) USING parquet LOCATION '{tmp_path}/{day}/{t}'")
    spark.sql("CREATE VIEW snap_2024_02.v AS SELECT 1 AS x")
    latest = catalog.resolve_namespace(spark, "LATEST: snap_2024_*")
    assert latest == "snap_2024_02"
    assert catalog.resolve_namespace(spark, "snap_2024_01") == "snap_2024_01"
    assert [tuple(r) for r in catalog.base_tables(spark, latest).collect()] == [(latest, "a"), (latest, "t")]
    tables = catalog.catalog_tables(spark, latest)
    assert {tuple(r) for r in files.row_counts(tables).collect()} == {("a", 0), ("t", 0)}
    assert catalog.columns_of(spark, tables).where("table_name = 't'").first().data_type == "int"


def test_records_are_read_against_a_declared_schema(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('{"a": "1"}\n{"a": "", "b": 2}\n')
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text('[{"a": "1"},\n {"a": "", "b": 2}]')
    schema = "a string, b int"
    expected = {("1", None), ("", 2)}
    assert {tuple(r) for r in records.read_records(spark, str(tmp_path / "lines"), schema).collect()} == expected
    array = records.read_records(spark, str(tmp_path / "array"), schema, array=True)
    assert {tuple(r) for r in array.collect()} == expected


def test_run_summary_and_views(spark):
    start = datetime(2024, 1, 1)
    rows = [
        ("a", "completed", 3, 3, start, start + timedelta(seconds=3661)),
        ("b", "failed", 4, None, start, None),
        ("c", "processing", None, None, start, None),
    ]
    status = spark.createDataFrame(
        rows,
        "table_name string, status string, src_rows bigint, dst_rows bigint,"
        " started_at timestamp_ntz, ended_at timestamp_ntz",
    )
    assert ledger.run_summary(status).first().asDict() == {
        "status": "running", "elapsed": "01:01:01", "total_tables": 3,
        "completed_tables": 1, "failed_tables": 1, "progress": 33,
    }
    empty = ledger.run_summary(status.limit(0)).first()
    assert (empty.elapsed, empty.progress, empty.total_tables) == ("00:00:00", 0, 0)
    counts = status.select("table_name", F.coalesce("src_rows", F.lit(0)).alias("total_rows"))
    fewer = counts.where("table_name <> 'b'")
    marks = {r.table_name: r.mark for r in ledger.reconcile(counts, fewer, status).collect()}
    assert marks == {"a": "[OK]", "b": "[X]", "c": "[ ]"}
    assert {r.mark for r in ledger.reconcile(counts, fewer).collect()} == {"[OK]", "[!]"}


def test_recent_messages_keep_the_newest_hundred(spark):
    log = spark.range(250).select(
        "id", F.when(F.col("id") % 2 == 0, "INFO").otherwise("ERROR").alias("level")
    )
    assert [r.id for r in ledger.recent_messages(log, ["id"]).collect()] == list(range(249, 149, -1))
    errors = ledger.recent_messages(log, ["id"], level="ERROR").collect()
    assert [r.id for r in errors] == list(range(249, 49, -2))


def test_database_read_ranges_join_without_gaps():
    assert jdbc.range_predicates("k", [1]) == ["1 = 1"]
    assert jdbc.range_predicates("k", [1, 10, 20]) == [
        "`k` < 10 OR `k` IS NULL", "`k` >= 10 AND `k` < 20", "`k` >= 20",
    ]
    assert jdbc.range_predicates("d", ["a", "o'b"], quote='"')[1] == "\"d\" >= 'o''b'"
    assert jdbc.read_options(5_000)["numPartitions"] == "1"
    assert jdbc.read_options(10**10)["numPartitions"] == "20000"
    assert jdbc.write_options(5_000_000) == {"batchsize": "5000", "numPartitions": "10"}
