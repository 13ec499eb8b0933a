"""Keep a keyed table up to date from a growing folder of files.

Each micro-batch is cleaned and reduced to one row per key, then written to a
folder named by its batch id. Writing a batch again replaces exactly that
folder, so a replay after a failure changes nothing. The cost of a batch
follows the size of the batch, not of the table.

The current table is the base version with all later batches merged in;
``compact`` folds them into a new base version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions import text as X
from tablewharf.functions.text import ref
from tablewharf.operators import clean, quality
from tablewharf.operators.upsert import latest_per_key, merge_by_key
from tablewharf.sinks.snapshots import write_version


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def upsert_stream(
    stream: DataFrame,
    folder: str,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    fill_numeric: float | None = 0,
    **limits: int,
) -> None:
    """Process all files that have arrived, then stop (run it on a schedule).

    A restart with the same ``folder`` goes on where the last run ended. Rows
    that a keyed target refuses go to ``refused`` with their reason. A table without a key
    is for :func:`distinct_stream`; an empty ``key`` is refused.
    """
    if not key:
        raise ValueError("a table without a key has no winners: use distinct_stream")
    reason = X.spare_name(stream.columns, "refusal_reason")

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = clean.clean_values(batch, fill_numeric, key)
        rows = quality.with_refusal_reason(rows, key, name=reason, **limits)
        # One winner per key also removes exact copies; no distinct is needed.
        good = rows.where(ref(reason).isNull()).drop(reason)
        write_version(latest_per_key(good, key, order_by), f"{folder}/changes/batch={batch_id:010d}")
        bad = rows.where(ref(reason).isNotNull())
        if not bad.isEmpty():
            write_version(bad, f"{folder}/refused/batch={batch_id:010d}")

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def distinct_stream(stream: DataFrame, folder: str, fill_numeric: float | None = 0) -> None:
    """Process all files that have arrived of a table without a key: each distinct row is kept once.

    The rows seen so far live in the state store, spread over its partitions; a row that comes again in any later
    batch or run is left out. Distinct is judged before cleaning, as in whole copies. A batch writes what is new under its batch
    id, and a replay writes the same again. For very many distinct rows set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which keeps state on disk.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        write_version(clean.clean_values(batch, fill_numeric), f"{folder}/changes/batch={batch_id:010d}")

    query = (
        stream.dropDuplicates()
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def distinct_table(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that :func:`distinct_stream` has kept."""
    return changes(spark, folder).drop("batch")


def changes(
    spark: SparkSession, folder: str, after_batch: int = -1, up_to: int | None = None
) -> DataFrame:
    """Changed rows with the ``batch`` that brought them; other batches are pruned."""
    rows = spark.read.parquet(f"{folder}/changes").where(F.col("batch") > after_batch)
    return rows if up_to is None else rows.where(F.col("batch") <= up_to)


def current_table(
    spark: SparkSession,
    folder: str,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    base: DataFrame | None = None,
    after_batch: int = -1,
    up_to: int | None = None,
) -> DataFrame:
    """The table after all batches: the order columns decide, then the later batch."""
    try:
        delta = changes(spark, folder, after_batch, up_to)
    except AnalysisException as error:
        # Nothing has arrived yet.
        if base is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return base
    winners = latest_per_key(delta, key, [*order_by, "batch"]).drop("batch")
    if base is None:
        return winners
    return merge_by_key(base, winners, key, order_by)


def compact(
    spark: SparkSession,
    folder: str,
    version: str,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    base: DataFrame | None = None,
    after_batch: int = -1,
) -> tuple[str, int]:
    """Write base and changes as a new base; returns its folder and last batch.

    Pass both to the next ``current_table``. The old base stays readable.
    """
    last = changes(spark, folder, after_batch).agg(F.max("batch")).first()[0]
    last = after_batch if last is None else int(last)
    table = current_table(spark, folder, key, order_by, base, after_batch, up_to=last)
    target = f"{folder}/base/version={version}"
    write_version(table, target)
    return target, last
