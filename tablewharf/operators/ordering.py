"""Rows in a total order: stored key ranges and exact prefix sums over any orderable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewharf.sinks.workspace import new_folder


def store(rows: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them back, which cuts lineage and
    survives lost executors. ``compression`` replaces the session's codec, for texts that take much room."""
    folder = new_folder(rows.sparkSession, purpose)
    writer = rows.write if compression is None else rows.write.option("compression", compression)
    writer.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def with_prefix(rows: DataFrame, order: Sequence[str | Column], measures: Sequence[str], purpose: str) -> DataFrame:
    """Rows in a total order, numbered and with running totals.

    Adds ``row_index`` (from 0) and, for every measure ``m`` (a whole number, not
    null), ``before_m`` (the sum over all earlier rows) and ``total_m``. Rows are cut
    into key ranges; the totals of the ranges, one row for each, give every range its
    start, so no task holds more than one range. Rows that repeat in all order columns
    are told apart by their place in the input, so even they spread over ranges.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = {f"__key{i}": key for i, key in enumerate(keys)}
    tied = tied.withColumns(named) if named else tied
    order_by = [*named, "__tie"]
    placed = store(tied.repartitionByRange(*order_by).withColumn("__range", F.spark_partition_id()), purpose)
    sums = [F.sum(m).alias(f"__sum_{m}") for m in measures]
    ranges = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"), *sums)
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    starts = ranges.select(
        "__range",
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__first"),
        *[F.coalesce(F.sum(f"__sum_{m}").over(earlier), F.lit(0)).alias(f"__start_{m}") for m in measures],
        *[F.sum(f"__sum_{m}").over(everything).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy("__range").orderBy(*order_by)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumns(
        {"__place": F.row_number().over(inside)} | {f"__upto_{m}": F.sum(m).over(running) for m in measures}
    )
    joined = numbered.join(starts, "__range")
    return joined.select(
        *rows.columns,
        (F.col("__first") + F.col("__place") - 1).cast("long").alias("row_index"),
        *[(F.col(f"__start_{m}") + F.col(f"__upto_{m}") - F.col(m)).cast("long").alias(f"before_{m}") for m in measures],
        *[F.col(f"total_{m}").cast("long") for m in measures],
    )
