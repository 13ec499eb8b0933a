"""Dated snapshots: every load writes a new version, then the name moves to it."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablewharf.functions.names import snapshot_name_text


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def run_namespace(
    spark: SparkSession,
    template: str,
    started: datetime,
    dated: bool = True,
    folder: str | None = None,
) -> str:
    """The destination of a run, named once from its start, created if missing.

    ``folder`` is where a new namespace keeps its data; without it the
    warehouse folder of the session is used.
    """
    namespace = snapshot_name_text(spark, template, started) if dated else template
    place = f" LOCATION '{_text(folder)}/{namespace}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(namespace)}{place}")
    return namespace


def write_version(df: DataFrame, folder: str, compression: str = "zstd") -> None:
    """Write one version of a table; a retried run replaces its own partial output."""
    df.write.mode("overwrite").option("compression", compression).parquet(folder)


def publish(spark: SparkSession, namespace: str, table: str, folder: str) -> None:
    """Point ``namespace.table`` at a written version.

    With the same columns only the location changes: readers see the old version or
    the new one. Other columns need a new table definition; between its drop and its
    creation the name is missing for a moment, and when the creation fails the old definition
    comes back.
    """
    full_name = f"{_name(namespace)}.{_name(table)}"
    written = spark.read.parquet(folder).schema
    location = _text(folder)
    old = None
    if spark.catalog.tableExists(full_name):
        if spark.table(full_name).schema == written:
            spark.sql(f"ALTER TABLE {full_name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(full_name)
            return
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").where("col_name = 'Location'")
        old = (_definition(spark.table(full_name).schema), details.first()["data_type"])
        spark.sql(f"DROP TABLE {full_name}")
    create = "CREATE TABLE {} ({}) USING parquet LOCATION '{}'"
    try:
        spark.sql(create.format(full_name, _definition(written), location))
    except Exception:
        if old:
            spark.sql(create.format(full_name, old[0], _text(old[1])))
        raise


def _definition(schema: StructType) -> str:
    return ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def full_refresh(df: DataFrame, namespace: str, table: str, folder: str) -> DataFrame:
    """Replace a table as a whole: write a new version under ``folder``, then swap.

    Every call writes into a folder of its own, so a plan that reads the table itself works and a failing write
    leaves the old version as it is.
    """
    spark = df.sparkSession
    version = f"{folder}/version-{uuid.uuid4().hex}"
    write_version(df, version)
    publish(spark, namespace, table, version)
    return spark.table(f"{_name(namespace)}.{_name(table)}")


def append_rows(df: DataFrame, folder: str) -> None:
    """Load without a key: add rows, repeats included."""
    df.write.mode("append").parquet(folder)
