"""Row counts per group that follow a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions.text import ref
from tablewharf.sinks.snapshots import write_version


def progress_stream(stream: DataFrame, folder: str, group: Sequence[str], latest: str) -> None:
    """Count rows per group and keep the newest ``latest`` value, batch by batch.

    Counts combine before the shuffle and the state holds one row per group.
    Every batch writes the whole small result under its own batch id.
    """
    counted = stream.groupBy(*[ref(g) for g in group]).agg(
        F.count(F.lit(1)).alias("rows_processed"), F.max(ref(latest)).alias("last_seen")
    )
    query = (
        counted.writeStream.outputMode("complete")
        .foreachBatch(lambda rows, n: write_version(rows, f"{folder}/progress/batch={n:010d}"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_progress(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/progress")
    newest = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == newest).drop("batch")
