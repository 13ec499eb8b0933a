"""Value rules on small frames with the awkward values in them."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewharf.functions import names
from tablewharf.functions import text as X
from tablewharf.operators import clean, infer, quality

INF, NAN = float("inf"), float("nan")


def column(df):
    return [row[0] for row in df.collect()]


def test_trim_removes_exactly_the_white_space_code_points(spark):
    assert len(set(X.WHITESPACE)) == 25
    assert all(c.isspace() for c in X.WHITESPACE)
    kept = "\u200b\ufeff\u180e"
    values = [f"{c}a{c}b{c}" for c in X.WHITESPACE + kept] + ["", " ", "a", "a ", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    result = column(clean.trim_strings(df))
    expected = [f"a{c}b" for c in X.WHITESPACE] + [f"{c}a{c}b{c}" for c in kept]
    assert result == expected + ["", "", "a", "a", None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(X.WHITESPACE + "aé漢\u200b"), max_size=6), min_size=1))
def test_trim_equals_strip_of_those_code_points(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert column(clean.trim_strings(df)) == [v.strip(X.WHITESPACE) for v in values]


def test_distinct_treats_nan_null_and_zero_signs_as_equal(spark):
    values = [None, NAN, INF, -INF, -0.0, 0.0, NAN]
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
    assert clean.distinct_rows(df).count() == 5
    assert clean.duplicate_summary(df).first().asDict() == {"rows_in": 7, "rows_out": 5, "removed": 2}
    assert set(column(clean.clean_values(df).select("v"))) == {0.0}


def test_distinct_accepts_maps(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, 1 AS copies UNION ALL SELECT map('b', 2, 'a', 1), 1")
    assert clean.distinct_rows(df).columns == ["m", "copies"]
    assert clean.distinct_rows(df).count() == 1


def test_null_fill_leaves_other_types_alone(spark):
    df = spark.sql(
        "SELECT CAST(NULL AS INT) i, CAST(NULL AS TINYINT) t, CAST(NULL AS FLOAT) f,"
        " CAST(NULL AS DECIMAL(20,0)) u, CAST(NULL AS DECIMAL(10,2)) d, CAST(NULL AS BOOLEAN) b,"
        " CAST(NULL AS DATE) dt, CAST(NULL AS STRING) s"
    )
    row = clean.clean_values(df).first()
    assert (row.i, row.t, row.f, row.u) == (0, 0, 0.0, 0)
    assert (row.d, row.b, row.dt, row.s) == (None, None, None, None)
    assert [f.dataType for f in clean.clean_values(df).schema] == [f.dataType for f in df.schema]
    assert clean.clean_values(df, fill_numeric=None).first().i is None
    assert clean.fill_numeric_nulls(df, 7).first().i == 7


def test_non_finite_repairs(spark):
    df = spark.createDataFrame([(v,) for v in (NAN, INF, -INF, 1.5, None)], "v double")
    assert column(clean.zero_non_finite(df)) == [0.0, 0.0, 0.0, 1.5, None]
    assert column(clean.null_non_finite(df)) == [None, None, None, 1.5, None]


def test_numbers_are_never_written_with_an_exponent(spark):
    values = [1.25e7, 1e-4, -0.0, NAN, INF, 123.5, -1.5e-10, 1e22, -12345678.5, 0.001, 9999999.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert column(clean.text_table(df)) == [
        "12500000.0", "0.0001", "0.0", None, None, "123.5", "-0.00000000015",
        "10000000000000000000000.0", "-12345678.5", "0.001", "9999999.0", None,
    ]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=50))
def test_number_text_reads_back_as_the_same_number(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    texts = column(clean.text_table(df))
    assert [float(t) for t in texts] == [v + 0.0 for v in values]
    assert not any("e" in t.lower() for t in texts)


def test_text_of_other_types(spark):
    df = spark.sql(
        "SELECT INTERVAL '1 02:03:04' DAY TO SECOND i, true b, CAST(1.50 AS DECIMAL(5,2)) d,"
        " CAST('1E-10' AS DECIMAL(20,10)) tiny, DATE'2024-01-01' dt, map(1, 2) m, array(1.5f) a,"
        " TIMESTAMP_NTZ'2024-03-10 02:30:00.987' ts, CAST(0.1 AS FLOAT) f, CAST(1e-5 AS FLOAT) g,"
        " X'6162' bin, CAST(5 AS TINYINT) t"
    )
    assert clean.text_table(df).first().asDict() == {
        "i": "26:03:04", "b": "1", "d": "1.50", "tiny": "0.0000000001",
        "dt": "2024-01-01 00:00:00", "m": '{"1":2}', "a": "[1.5]",
        "ts": "2024-03-10 02:30:00", "f": "0.1", "g": "0.00001", "bin": "ab", "t": "5",
    }


def test_times_do_not_depend_on_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' ts")  # a local time that never was
        assert column(clean.text_table(df)) == ["2024-03-10 02:30:00"]
        named = df.select(names.snapshot_name("{HH}{mm}", F.col("ts")))
        assert column(named) == ["0230"]
        moment = datetime(2024, 1, 1, 0, 30)
        assert names.snapshot_name_text(spark, "{YYYY}{MM}{DD}", moment) == "20240101"
        texts = spark.createDataFrame([("2024-03-10 02:30:00",)], "seen_date string")
        assert column(infer.coerce_datetimes(texts)) == [datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sentinels_in_any_case_become_null(spark):
    gone = ["nan", "NaN", "INF", "-Inf", "Null", "NONE"]
    kept = ["nano", "", " nan", "nan ", "+inf", "n/a", "nil"]
    df = spark.createDataFrame([(v,) for v in gone + kept], "s string")
    assert column(clean.text_table(df)) == [None] * len(gone) + kept


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [(1, " a ", NAN, None), (None, "null", 1.0, Decimal("1.10")), (3, None, None, None)],
        "i int, s string, f double, d decimal(9,2)",
    )
    once = clean.clean_values(df)
    assert clean.clean_values(once).collect() == once.collect()
    text = clean.text_table(once)
    assert clean.text_table(clean.clean_values(text)).collect() == text.collect()


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert {tuple(r) for r in quality.null_profile(df).collect()} == {("b", 1), ("c", 2)}
    assert quality.null_profile(df.limit(0)).count() == 0


def test_datetimes_are_read_month_first(spark):
    day = datetime(2024, 1, 5)
    expected = {
        "2024-01-02 03:04:05.123456": datetime(2024, 1, 2, 3, 4, 5, 123456),
        "2024-01-05T03:04:05.123": datetime(2024, 1, 5, 3, 4, 5, 123000),
        "2024-01-05 3:4": datetime(2024, 1, 5, 3, 4),
        " 2024-1-5 ": day, "2024/01/05": day, "2024.01.05": day, "20240105": day,
        "01/05/2024": day, "1/5/2024 10:11": datetime(2024, 1, 5, 10, 11),
        "31/01/2024": datetime(2024, 1, 31), "13-01-2024": datetime(2024, 1, 13),
        "05.01.2024": datetime(2024, 5, 1),
        "Jan 5, 2024": day, "January 5 2024": day, "5 January 2024": day, "05-Jan-2024": day,
        "bad": None, "": None, "2024-13-01": None, "2024-02-30": None, "0000-00-00": None,
        "2024": None, "12:30": None, None: None,
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05+07:00": datetime(2024, 1, 1, 20, 4, 5),
        "2024-01-02 03:04:05.123456789-0130": datetime(2024, 1, 2, 4, 34, 5, 123456),
        "1/5/2024 3:04 PM": datetime(2024, 1, 5, 15, 4), "2024-01-05 12:04:05am": datetime(2024, 1, 5, 0, 4, 5),
        "1/5/24": day, "13-01-24": datetime(2024, 1, 13), "2024-01": datetime(2024, 1, 1),
        "Fri, 05 Jan 2024 10:11:12 GMT": datetime(2024, 1, 5, 10, 11, 12), "Friday 5 January 2024": day,
    }
    df = spark.createDataFrame([(text,) for text in expected], "UPDATED string")
    assert infer.looks_like_datetime("UPDATED") and not infer.looks_like_datetime("dat")
    assert dict(zip(expected, column(infer.coerce_datetimes(df)))) == expected
    lost = infer.lost_datetimes(df, ["UPDATED"]).first()
    assert lost.lost == sum(v is None for k, v in expected.items() if k)
    mixed = spark.createDataFrame([(1, "x")], "lifetime_value int, note string")
    assert infer.coerce_datetimes(mixed).schema == mixed.schema
    assert column(infer.coerce_datetimes(mixed, ["note"]).select("note")) == [None]


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["1", "2.5", ".5", "1e3", "-7"], [1.0, 2.5, 0.5, 1000.0, -7.0]),
        ([" 1 ", "007", "", None], [1.0, 7.0, None, None]),
        (["inf", "-inf"], [INF, -INF]),
        (["1", "0x10"], None),
        (["1_000", "1"], None),
        (["1,000"], None),
        (["nan", "1"], None),
        (["True"], None),
        (["1d", "2"], None),
    ],
)
def test_numbers_are_inferred_for_whole_columns_only(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert column(infer.infer_numbers(df)) == (values if expected is None else expected)


def test_snapshot_names(spark):
    moment = datetime(2025, 11, 8, 9, 7, 5)
    assert names.snapshot_name_text(spark, "copy_{YYYY}.{MM}-{DD}", moment) == "copy_2025_11_08"
    assert names.snapshot_name_text(spark, "{HH}{mm}{ss}_{mm}", moment) == "090705_07"
    assert names.snapshot_name_text(spark, "plain", moment) == "plain"


@pytest.mark.parametrize(
    ("pattern", "name", "fits"),
    [
        ("backup_*", "backup_1", True),
        ("backup_*", "BACKUP_1", False),
        ("backup_*", "old_backup_1", False),
        ("b?", "ba", True),
        ("b?", "bat", False),
        ("[ab]*", "cat", False),
        ("[!ab]*", "cat", True),
        ("a.b", "axb", False),
        ("a", "a\n", False),
    ],
)
def test_patterns_match_whole_names(spark, pattern, name, fits):
    assert spark.range(1).select(names.matches_glob(F.lit(name), pattern)).first()[0] is fits


def test_durations_and_percentages(spark):
    row = spark.range(1).select(
        X.duration_text(F.lit(0)).alias("a"),
        X.duration_text(F.lit(360061.9)).alias("b"),
        X.percent(F.lit(1), F.lit(8)).alias("c"),
        X.percent(F.lit(5), F.lit(0)).alias("d"),
        X.percent(F.lit(2), F.lit(2)).alias("e"),
    ).first()
    assert tuple(row) == ("00:00:00", "100:01:01", 13, 0, 100)


def test_dates_count_as_values(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),)], "d date")
    assert column(clean.text_table(df)) == ["2024-02-29 00:00:00"]
