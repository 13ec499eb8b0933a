"""Writing tables to a relational database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tablewharf.functions.text import quoted
from tablewharf.operators.quality import MAX_KEY_CHARS
from tablewharf.sources.jdbc import write_options


def text_column_types(df: DataFrame, key: Sequence[str]) -> str:
    """Destination types in Spark's own words: bounded text for keys. The others are left to
    the dialect, whose text has no bound."""
    return ", ".join(f"{quoted(c)} VARCHAR({MAX_KEY_CHARS})" for c in df.columns if c in key)


def replace_table(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    key: Sequence[str] = (),
    total_rows: int = 0,
    table_options: str = "",
) -> None:
    """Drop, re-create and fill a table in batches of its size tier.

    Rows have one winner per key by now, so plain inserts do what an upsert
    would. ``table_options`` is added to CREATE TABLE, for example a character
    set; key constraints are for the database to add afterwards.
    """
    (
        df.write.format("jdbc")
        .options(**options, **write_options(total_rows), dbtable=table)
        .option("createTableColumnTypes", text_column_types(df, key))
        .option("createTableOptions", table_options)
        .mode("overwrite")
        .save()
    )


def append_rows(df: DataFrame, options: Mapping[str, str], table: str, total_rows: int = 0) -> None:
    (
        df.write.format("jdbc")
        .options(**options, **write_options(total_rows), dbtable=table)
        .mode("append")
        .save()
    )
