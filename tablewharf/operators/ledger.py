"""Run ledgers as tables: status, progress, reconciliation and recent messages.

A ledger is append-only: one row per status change of a table in a run. Every
view below is a query over those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewharf.functions.text import duration_text, percent
from tablewharf.operators.upsert import latest_per_key

LEDGER_SCHEMA = (
    "run_id string, table_name string, status string, attempt int, logged_at timestamp_ntz,"
    " progress int, src_rows bigint, dst_rows bigint, duplicates bigint, superseded bigint,"
    " quarantined bigint, batch_rows int, nulls string,"
    " location string, error string"
)

RECONCILED_SCHEMA = "table_name string, src_rows bigint, dst_rows bigint, status string, mark string"

# Table states and the mark each gets in a reconciliation.
MATCH, MISMATCH, FAILED, OPEN = "[OK]", "[!]", "[X]", "[ ]"

# Fixed value: how many messages a recent log keeps.
RECENT_MESSAGES = 100


def current_status(
    ledger: DataFrame, key: Sequence[str] = ("table_name",), order_by: Sequence[str] = ("logged_at",)
) -> DataFrame:
    """The newest ledger row of each table."""
    return latest_per_key(ledger, key, order_by)


def with_spans(
    ledger: DataFrame, key: Sequence[str] = ("table_name",), order_by: Sequence[str] = ("logged_at",)
) -> DataFrame:
    """Newest row of each table, with the times of its first and last row, from one aggregate."""
    rest = [c for c in ledger.columns if c not in (*key, *order_by)]
    ordered = [*order_by, *rest]
    grouped = ledger.groupBy(*key).agg(
        F.max(F.struct(*ordered)).alias("newest"),
        F.min("logged_at").alias("started_at"),
        F.max("logged_at").alias("ended_at"),
    )
    columns = [F.col("newest").getField(c).alias(c) for c in ledger.columns if c not in key]
    return grouped.select(*key, *columns, "started_at", "ended_at")


def progress_view(status: DataFrame, only: str | None = None) -> DataFrame:
    """One row per table with a default for whatever is still unknown.

    ``only="processing"`` keeps the tables being worked on.
    """
    defaults = {
        "status": F.lit("pending"),
        "src_rows": F.lit(0).cast("bigint"),
        "dst_rows": F.lit(0).cast("bigint"),
        "progress": F.lit(0),
        "batch_rows": F.lit(0),
    }
    view = status.select(
        "table_name",
        *[F.coalesce(F.col(name), default).alias(name) for name, default in defaults.items()],
        "error",
    )
    return view if only is None else view.where(F.col("status") == only)


def run_summary(status: DataFrame) -> DataFrame:
    """One row: state of the run, elapsed time, table counts and percent done.

    ``status`` holds one row per table with its times, as from ``with_spans``.
    """
    done = F.col("completed_tables")
    failed = F.col("failed_tables")
    total = F.col("total_tables")
    seconds = F.timestamp_diff("SECOND", F.col("started"), F.col("ended"))
    return status.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("status") == "completed").alias("completed_tables"),
        F.count_if(F.col("status") == "failed").alias("failed_tables"),
        F.count_if(F.col("status") == "empty").alias("empty_tables"),
        F.min("started_at").alias("started"),
        F.max("ended_at").alias("ended"),
    ).select(
        F.when(done + failed + F.col("empty_tables") >= total, "completed")
        .otherwise("running")
        .alias("status"),
        F.coalesce(duration_text(seconds), F.lit("00:00:00")).alias("elapsed"),
        "total_tables",
        "completed_tables",
        "failed_tables",
        percent(done, total).alias("progress"),
    )


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def reconcile(source: DataFrame, destination: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Compare row counts per table name; both sides hold ``table_name`` and a count.

    A table on one side only counts as zero rows on the other. Without
    ``status`` every table is taken as completed.
    """
    src = source.select("table_name", F.col("total_rows").alias("s"))
    dst = destination.select("table_name", F.col("total_rows").alias("d"))
    both = src.join(dst, "table_name", "full_outer")
    if status is None:
        both = both.withColumn("status", F.lit("completed"))
    else:
        both = both.join(status.select("table_name", "status"), "table_name", "left")
    src_rows = F.coalesce(F.col("s"), F.lit(0).cast("bigint"))
    dst_rows = F.coalesce(F.col("d"), F.lit(0).cast("bigint"))
    completed = F.col("status") == "completed"
    return both.select(
        "table_name",
        src_rows.alias("src_rows"),
        dst_rows.alias("dst_rows"),
        F.coalesce(F.col("status"), F.lit("pending")).alias("status"),
        F.when(completed & (src_rows == dst_rows), MATCH)
        .when(completed, MISMATCH)
        .when(F.col("status") == "failed", FAILED)
        .otherwise(OPEN)
        .alias("mark"),
    )


def recent_messages(
    log: DataFrame, order_by: Sequence[str], level: str | None = None, keep: int = RECENT_MESSAGES
) -> DataFrame:
    """The newest messages first; ``level`` keeps one severity."""
    chosen = log if level is None else log.where(F.col("level") == level)
    return chosen.orderBy(*[F.col(c).desc() for c in order_by]).limit(keep)


def run_messages(ledger: DataFrame) -> DataFrame:
    """``logged_at, level, table_name, message``: each status change as a line of the run's log."""
    status, attempt = F.col("status"), F.col("attempt")
    level = F.when(status == "failed", "ERROR").when(status == "retrying", "WARNING").otherwise("INFO")
    counts = [
        F.when(F.col(c) > 0, F.concat(F.lit(", "), F.col(c), F.lit(f" {c}"))).otherwise("")
        for c in ("duplicates", "superseded", "quarantined")
    ]
    loaded = F.concat(F.lit("loaded "), F.col("dst_rows"), F.lit(" of "), F.col("src_rows"), F.lit(" rows"), *[F.coalesce(c, F.lit("")) for c in counts])
    message = (
        F.when(status == "failed", F.concat(F.lit("failed: "), F.coalesce("error", F.lit("unknown error"))))
        .when(status == "retrying", F.coalesce("error", F.lit("trying again")))
        .when(status == "processing", F.concat(F.lit("started, attempt "), attempt))
        .when(status == "empty", "nothing to load")
        .when((status == "completed") & (attempt > 0), loaded)
        .otherwise(status)
    )
    return ledger.select("logged_at", level.alias("level"), "table_name", message.alias("message"))


def reconciliation_messages(reconciled: DataFrame, ledger: DataFrame) -> DataFrame:
    """A line for each reconciled table, at the end of the run; what does not match is a warning."""
    ended = ledger.agg(F.max("logged_at").alias("logged_at"))
    level = F.when(F.col("mark").isin(MATCH, OPEN), "INFO").otherwise("WARNING").alias("level")
    message = F.concat(F.col("mark"), F.lit(" "), F.col("dst_rows"), F.lit(" of "), F.col("src_rows"), F.lit(" rows")).alias("message")
    return reconciled.join(F.broadcast(ended)).select("logged_at", level, "table_name", message)
