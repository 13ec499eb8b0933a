"""Copy a database into a dated snapshot: find tables, choose, copy, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions.text import is_integer, ref
from tablewharf.operators.selection import select_tables
from tablewharf.plans.run import Ledger, copy_tables, local_now
from tablewharf.plans.table_job import TableJob
from tablewharf.sinks.snapshots import run_namespace, write_version
from tablewharf.sources import catalog, jdbc

Keys = Mapping[str, tuple[str, ...]]


def chosen_names(tables: DataFrame, include: str, exclude: str, globs: bool) -> list[str]:
    chosen = select_tables(tables.select("table_name"), include, exclude, globs)
    return [row["table_name"] for row in chosen.orderBy("table_name").collect()]


def catalog_jobs(
    spark: SparkSession,
    source: str,
    include: str = "",
    exclude: str = "",
    globs: bool = False,
    keys: Keys | None = None,
    order_by: Keys | None = None,
    collation: str | None = None,
) -> list[TableJob]:
    """Jobs for the base tables of a namespace, or of the newest ``LATEST:`` match."""
    namespace = catalog.resolve_namespace(spark, source)
    names = chosen_names(catalog.base_tables(spark, namespace), include, exclude, globs)
    return [
        TableJob(
            name,
            spark.table(f"`{namespace}`.`{name}`"),
            tuple((keys or {}).get(name, ())),
            tuple((order_by or {}).get(name, ())),
            collation=collation,
        )
        for name in names
    ]


def database_jobs(
    spark: SparkSession,
    options: Mapping[str, str],
    schema: str,
    landing: str,
    include: str = "",
    exclude: str = "",
    globs: bool = False,
    order_by: Keys | None = None,
) -> list[TableJob]:
    """Jobs for the base tables of a relational database.

    Every table is read once, in key ranges, when its turn comes, and lands as Parquet in the shared
    folder ``landing``. A table that cannot be read fails alone. Later passes and retries then see the same rows and do
    not load the database again.
    """
    names = chosen_names(jdbc.base_tables(spark, options, schema), include, exclude, globs)
    keys = catalog.keys_by_table(catalog.primary_keys(*jdbc.key_metadata(spark, options, schema)))

    def land(job: TableJob) -> TableJob:
        return _landed(spark, options, job, f"{landing}/{job.name}")

    return [
        TableJob(name, None, keys.get(name, ()), (order_by or {}).get(name, ()), prepare=land)
        for name in names
    ]


def _landed(spark: SparkSession, options: Mapping[str, str], job: TableJob, folder: str) -> TableJob:
    name, key = job.name, job.key
    rows = jdbc.row_count(spark, options, name)
    whole = jdbc.read_table(spark, options, name)
    integers = [k for k in key if is_integer(whole.schema[k].dataType)]
    bounds = None
    if integers and rows:
        low, high = whole.agg(F.min(ref(integers[0])), F.max(ref(integers[0]))).first()
        bounds = (str(low), str(high))
    table = jdbc.read_table(spark, options, name, integers[0] if integers else None, bounds, rows)
    write_version(table, folder)
    # The database enforces its keys; only cleaning could make text keys collide.
    unique = True if key and len(integers) == len(key) else None
    return replace(job, source=spark.read.parquet(folder), key_is_unique=unique)


def copy_database(
    spark: SparkSession,
    jobs: list[TableJob],
    destination: str,
    folder: str,
    dated: bool = True,
    started: datetime | None = None,
    registry: Callable[[str], object] | None = None,
    **options,
) -> tuple[str, Ledger]:
    """Copy tables into one namespace, named from the start of the run in the session's time zone.

    ``registry`` loads registry records into that namespace first; its outcome is in the ledger, and its failure
    does not stop the tables. At the end the loaded tables are counted and reconciled. Returns the namespace and the ledger.
    """
    namespace = run_namespace(spark, destination, started or local_now(spark), dated, folder)
    before = None if registry is None else lambda: registry(namespace)
    options = {"reconciled": True, **options}
    ledger = copy_tables(spark, jobs, f"{folder}/{namespace}", namespace, before=before, step="registry", **options)
    return namespace, ledger
