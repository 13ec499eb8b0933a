"""Copy many tables in one run, keeping a ledger of every attempt."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.operators.chunks import size_tier
from tablewharf.operators.ledger import (
    LEDGER_SCHEMA,
    RECONCILED_SCHEMA,
    current_status,
    reconcile,
    reconciliation_messages,
    run_messages,
)
from tablewharf.plans.table_job import TableJob, TableResult, run_table
from tablewharf.sinks.snapshots import publish

log = logging.getLogger(__name__)

# Attempts per table and the pause between them in seconds.
MAX_ATTEMPTS = 3
RETRY_SECONDS = 5.0


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def local_now(spark: SparkSession) -> datetime:
    """The wall clock of the session's time zone, by which people name days."""
    now = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("now"))
    return now.first()["now"]


@dataclass
class Ledger:
    """Append-only status rows under one folder."""

    spark: SparkSession
    folder: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def add(self, table: str, status: str, attempt: int, **values) -> None:
        values = {
            "run_id": self.run_id,
            "table_name": table,
            "status": status,
            "attempt": attempt,
            "logged_at": str(utc_now()),
            **values,
        }
        columns = []
        for part in LEDGER_SCHEMA.split(","):
            name, dtype = part.split()
            columns.append(F.lit(values.get(name)).cast(dtype).alias(name))
        row = self.spark.range(0, 1, 1, 1).select(*columns)
        # Tables copied at the same time would disturb each other's commits if
        # they appended to one folder, so every entry has a folder of its own.
        row.write.mode("overwrite").parquet(f"{self.folder}/{self.run_id}/{table}-{attempt}-{status}")

    def rows(self, all_runs: bool = False, steps: bool = False) -> DataFrame:
        """Entries of this run, or of all runs that share the folder.

        ``steps`` adds those of the steps before the tables; their attempt is 0.
        """
        reader = self.spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true")
        rows = reader.parquet(self.folder if all_runs else f"{self.folder}/{self.run_id}")
        return rows if steps else rows.where("attempt > 0")

    def final(self) -> DataFrame:
        """The last entry of each table of this run."""
        return current_status(self.rows(), order_by=["attempt", "logged_at"])

    def reconcile(self) -> None:
        """Count what the completed tables hold now, compare it with what the run says it loaded, and keep the result."""
        final = self.final()
        left = "src_rows - coalesce(duplicates, 0) - coalesce(superseded, 0) - coalesce(quarantined, 0) AS total_rows"
        counts = [
            self.spark.read.parquet(row["location"]).agg(F.lit(row["table_name"]).alias("table_name"), F.count(F.lit(1)).alias("total_rows"))
            for row in final.where("location IS NOT NULL").select("table_name", "location").collect()
        ]
        nothing = final.limit(0).select("table_name", F.lit(0).cast("bigint").alias("total_rows"))
        destination = reduce(DataFrame.union, counts, nothing)
        found = reconcile(final.selectExpr("table_name", left), destination, final)
        found.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}-reconciled/{self.run_id}")

    def reconciliation(self) -> DataFrame:
        """``table_name, src_rows, dst_rows, status, mark``: rows that a table should hold, and those it was found to hold."""
        return self.spark.read.schema(RECONCILED_SCHEMA).parquet(f"{self.folder}-reconciled/{self.run_id}")

    def messages(self, reconciled: bool = False) -> DataFrame:
        """What happened in this run, as log lines; with those of its reconciliation."""
        lines = run_messages(self.rows(steps=True))
        return lines.union(reconciliation_messages(self.reconciliation(), self.rows())) if reconciled else lines


def copy_table(
    ledger: Ledger,
    job: TableJob,
    folder: str,
    namespace: str | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    retry_seconds: float = RETRY_SECONDS,
    runner: Callable[[TableJob, str], TableResult] = run_table,
) -> str:
    """Copy one table, trying again on failure; returns its final status."""
    spark = ledger.spark
    for attempt in range(1, max_attempts + 1):
        if attempt > 1:
            note = f"trying again, {attempt} of {max_attempts}"
            ledger.add(job.name, "retrying", attempt, progress=0, error=note)
            time.sleep(retry_seconds)
        ledger.add(job.name, "processing", attempt, progress=0)
        try:
            # Every attempt has its own folder: a late task of a failed one
            # cannot write into the output of the next.
            result = runner(job, f"{folder}/attempt-{attempt}")
            if result.src_rows == 0:
                ledger.add(job.name, "empty", attempt, progress=100, src_rows=0, dst_rows=0)
                return "empty"
            if namespace:
                publish(spark, namespace, job.name, result.location)
        except Exception as error:  # one table never stops the others
            log.warning("table %s, attempt %d: %s", job.name, attempt, error)
            ledger.add(job.name, "failed", attempt, progress=0, error=str(error))
            continue
        counts = {k: v for k, v in asdict(result).items() if k not in ("quarantine", "nulls")}
        tier = size_tier(result.src_rows)
        ledger.add(
            job.name,
            "completed",
            attempt,
            progress=100,
            batch_rows=tier["batch_rows"],
            nulls=json.dumps(result.nulls) if result.nulls else None,
            **counts,
        )
        return "completed"
    return "failed"


def copy_tables(
    spark: SparkSession,
    jobs: Iterable[TableJob],
    folder: str,
    namespace: str | None = None,
    at_once: int = 1,
    before: Callable[[], object] | None = None,
    step: str = "preparation",
    reconciled: bool = False,
    **options,
) -> Ledger:
    """Copy all tables and return the ledger of the run.

    ``at_once`` tables share the cluster, so that small tables do not leave it
    idle. ``before`` is a step such as a registry load; its outcome goes to the ledger under the name ``step``, and
    its failure does not stop the run. ``reconciled`` counts all loaded tables at the end.
    """
    jobs = list(jobs)
    ledger = Ledger(spark, f"{folder}/ledger")
    if before is not None:
        try:
            done = before()
            ledger.add(step, "empty" if done is False else "completed", 0, progress=100)
        except Exception as error:
            log.warning("%s failed, continuing: %s", step, error)
            ledger.add(step, "failed", 0, progress=0, error=str(error))

    # A folder per run: versions that are still published stay untouched.
    target = f"{folder}/{ledger.run_id}"

    def one(job: TableJob) -> str:
        return copy_table(ledger, job, target, namespace, **options)

    if at_once <= 1:
        for job in jobs:
            one(job)
    else:
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            list(pool.map(inheritable_thread_target(spark)(one), jobs))
    if reconciled and jobs:
        ledger.reconcile()
    return ledger
