"""Parquet tables laid out as ``<folder>/<table>.parquet``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, table: str, limit: int | None = None) -> DataFrame:
    """The whole table; ``limit`` takes that many rows for a trial."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df if limit is None else df.limit(limit)


def read_tables(spark: SparkSession, folder: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in tables}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, total_rows)``; the scans read no column at all.

    All tables are counted by one aggregate with one shuffle. Every name brings a row
    that counts nothing, so empty tables are listed too.
    """
    session = next(iter(tables.values())).sparkSession
    names = session.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(name) for name in tables])).alias("table_name"), F.lit(0).alias("one")
    )
    tagged = [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("one")) for name, df in tables.items()]
    rows = reduce(DataFrame.unionAll, tagged, names)
    return rows.groupBy("table_name").agg(F.sum("one").cast("bigint").alias("total_rows"))
