"""Time the headline queries and print one JSON line.

Each query is run to completion: lazy results go to Spark's ``noop`` sink, the
table copies write parquet. One untimed run warms the session up, then the
median of ``BENCH_RUNS`` runs counts. ``rows_per_sec`` relates it to the rows
the query reads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import load_all  # noqa: E402
from checks.data import KEYS, TABLES, table  # noqa: E402
from tablewharf.plans.run import copy_tables  # noqa: E402
from tablewharf.plans.settings import run_settings  # noqa: E402
from tablewharf.plans.table_job import TableJob, run_table  # noqa: E402
from tablewharf.sinks.workspace import new_folder  # noqa: E402

# Registered queries to time, with the tables each reads.
QUERIES = {
    "a2_deep_page": ["orders"],
    "a4_row_counts": list(TABLES),
    "a6_key_check": list(TABLES),
    "b3_chunk_manifest_fine": ["lineitem"],
    "d1_distinct_copied_table": ["lineitem", "lineitem"],
    "d1_removed_counts": ["labels", "documents", "events", "lineitem", "conversations", "pages"],
    "d2_trim_documents": ["documents"],
    "d4_all_repairs": ["events"],
    "d7_numeric_inference": ["orders"],
    "d10_sentinels_to_null": ["orders"],
    "d13_text_table": ["lineitem"],
    "f1_latest_per_key": ["events"],
    "f1_composite_key": ["lineitem"],
    "f1_merge_replaces": ["orders"],
    "f4_accepted_rows": ["documents"],
    "f5_byte_batches": ["documents"],
    "f10_registry_table": ["events"],
    "h1_current_status": ["events"],
    "s1_incremental_upsert": ["events"],
    "s2_stream_progress": ["events"],
}


def copy_lineitem(key, unique):
    def run(spark, folder):
        # The file has one row group, which one task reads: deal its rows to all cores.
        spread = spark.sparkContext.defaultParallelism if unique else None
        job = TableJob("lineitem", table(spark, folder, "lineitem"), key, key_is_unique=unique, spread=spread)
        run_table(job, new_folder(spark, "bench"))

    return run


def copy_everything(spark, folder):
    jobs = [TableJob(t, table(spark, folder, t), KEYS[t]) for t in TABLES]
    copy_tables(spark, jobs, new_folder(spark, "bench"), at_once=8)


# Whole copies: read, clean, write as text.
COPIES = {
    "copy_lineitem_no_key": (copy_lineitem((), None), ["lineitem"]),
    "copy_lineitem_upsert": (copy_lineitem(KEYS["lineitem"], None), ["lineitem"]),
    "copy_lineitem_trusted_key": (copy_lineitem(KEYS["lineitem"], True), ["lineitem"]),
    "copy_all_tables": (copy_everything, list(TABLES)),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = run_settings(shuffle_bytes=1 << 30, cores=cpus)
    settings.update(
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        }
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    rows = {t: table(spark, folder, t).count() for t in TABLES}
    checks = load_all()

    def timed_query(name):
        def run(spark, folder):
            checks[name].query(spark, folder).write.format("noop").mode("overwrite").save()

        return run

    work = {name: (timed_query(name), tables) for name, tables in QUERIES.items()}
    work.update(COPIES)
    only = os.environ.get("BENCH_ONLY")
    if only:
        work = {n: w for n, w in work.items() if any(part in n for part in only.split(","))}
    seconds, speed = {}, {}
    for name, (run, tables) in work.items():
        run(spark, folder)
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run(spark, folder)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
        speed[name] = round(sum(rows[t] for t in tables) / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": speed,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
