"""What exists: tables, columns, declared keys and dated snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions.names import LATEST_PREFIX, matches_glob

COLUMNS_SCHEMA = "table_name string, column_name string, position int, data_type string"


def columns_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, position, data_type)`` of DataFrames, from 1."""
    rows = [
        (name, field.name, position, field.dataType.simpleString())
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def base_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """``(table_schema, table_name)`` of one namespace by name; views stay out."""
    rows = [
        (namespace, t.name)
        for t in spark.catalog.listTables(namespace)
        if not t.isTemporary and t.tableType != "VIEW"
    ]
    found = spark.createDataFrame(rows, "table_schema string, table_name string")
    return found.orderBy("table_name")


def catalog_tables(spark: SparkSession, namespace: str) -> dict[str, DataFrame]:
    """Readers of all base tables of a namespace."""
    names = [row["table_name"] for row in base_tables(spark, namespace).collect()]
    return {name: spark.table(f"`{namespace}`.`{name}`") for name in names}


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Key columns per table in key order, from two metadata tables.

    ``constraints`` holds (constraint_name, table_schema, table_name,
    constraint_type); ``usage`` holds (constraint_name, table_schema,
    table_name, column_name, ordinal_position).
    """
    return (
        constraints.where(F.col("constraint_type") == "PRIMARY KEY")
        .join(usage, ["constraint_name", "table_schema", "table_name"], "inner")
        .select("table_schema", "table_name", "column_name", "ordinal_position")
        .orderBy("table_schema", "table_name", "ordinal_position")
    )


def keys_by_table(keys: DataFrame) -> dict[str, tuple[str, ...]]:
    """``primary_keys`` as a lookup for the driver: a few names per table."""
    found: dict[str, list[tuple[int, str]]] = {}
    for row in keys.collect():
        found.setdefault(row["table_name"], []).append((row["ordinal_position"], row["column_name"]))
    return {table: tuple(name for _, name in sorted(columns)) for table, columns in found.items()}


def latest_name(names: DataFrame, pattern: str, column: str = "name") -> str:
    """The greatest name that fits a shell-style pattern; an error when none does."""
    newest = names.where(matches_glob(F.col(column), pattern)).agg(F.max(column)).first()[0]
    if newest is None:
        raise ValueError(f"no name matches {pattern!r}")
    return newest


def resolve_namespace(spark: SparkSession, name: str) -> str:
    """``LATEST:<pattern>`` as the newest namespace; any other name as it is."""
    if not name.startswith(LATEST_PREFIX):
        return name
    found = [(d.name,) for d in spark.catalog.listDatabases()]
    names = spark.createDataFrame(found, "name string")
    return latest_name(names, name[len(LATEST_PREFIX):].strip())


def latest_rows(df: DataFrame, name_column: str, pattern: str) -> DataFrame:
    """Rows of the newest matching snapshot in data tagged with snapshot names.

    The newest name is found first and becomes a literal filter, so a table
    partitioned by snapshot reads one partition.
    """
    return df.where(F.col(name_column) == latest_name(df, pattern, name_column))
