"""Copy a database from the command line, for example with spark-submit.

    spark-submit run_copy.py --source 'LATEST:clinic_*' \\
        --destination 'warehouse_{YYYY}_{MM}_{DD}' --folder hdfs:///copies

Run it from a scheduler for periodic copies.
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tablewharf.operators import ledger as reports
from tablewharf.operators.selection import GENERATED_COLUMNS
from tablewharf.plans.database import catalog_jobs, copy_database, database_jobs
from tablewharf.plans.settings import run_settings
from tablewharf.sinks.registry import load_registry
from tablewharf.sources import records


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tablewharf", description=__doc__)
    add = parser.add_argument
    add("--source", required=True, help="namespace, LATEST:<pattern>, or schema of the database")
    add("--destination", required=True, help="namespace; {YYYY} {MM} {DD} {HH} {mm} {ss} are filled in")
    add("--folder", required=True, help="shared folder for the written tables and the ledger")
    add("--static", action="store_true", help="take the destination name as it is")
    add("--include", default="", help="comma-separated tables to copy; none means all")
    add("--exclude", default="", help="comma-separated tables to leave out")
    add("--globs", action="store_true", help="read include and exclude as patterns")
    add("--keys", type=json.loads, default={}, help='JSON such as {"visits": ["visit_id"]}')
    add("--order-by", type=json.loads, default={}, help="JSON like --keys: which row is the later one")
    add("--jdbc", action="append", default=[], metavar="NAME=VALUE", help="JDBC option of a database source")
    add("--at-once", type=int, default=1, help="tables that share the cluster")
    add("--max-attempts", type=int, default=3)
    add("--shuffle-bytes", type=int, default=50 << 30, help="bytes of the largest shuffle, for its partitions")
    add("--cores", type=int, default=200, help="cores of the cluster")
    add("--retry-seconds", type=float, default=5.0)
    add("--collation", help="how text keys compare, for example UNICODE_CI; none means exactly")
    add("--registry-records", help="JSON files of registry records, loaded before the tables")
    add("--registry-columns", default="", help="comma-separated columns of the registry table")
    add("--registry-table", default="registry")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one copy; the exit status is 1 if a table failed."""
    args = arguments(argv)
    if spark is None:
        settings = run_settings(args.shuffle_bytes, args.cores)
        spark = SparkSession.builder.appName("tablewharf").config(map=settings).getOrCreate()
    choice = {"include": args.include, "exclude": args.exclude, "globs": args.globs}
    if args.jdbc:
        options = dict(option.split("=", 1) for option in args.jdbc)
        landing = f"{args.folder}/landing/{uuid.uuid4().hex}"
        jobs = database_jobs(spark, options, args.source, landing, order_by=args.order_by, **choice)
        jobs = [replace(job, collation=args.collation) for job in jobs]
    else:
        jobs = catalog_jobs(spark, args.source, keys=args.keys, order_by=args.order_by, collation=args.collation, **choice)

    def registry(namespace: str) -> bool:
        columns = [c.strip() for c in args.registry_columns.split(",") if c.strip()]
        texts = T.StructType([T.StructField(c, T.StringType()) for c in columns if c not in GENERATED_COLUMNS])
        found = records.read_records(spark, args.registry_records, texts)
        target = f"{args.folder}/{namespace}/{args.registry_table}"
        return load_registry(found, columns, namespace, args.registry_table, target)

    namespace, ledger = copy_database(
        spark,
        jobs,
        args.destination,
        args.folder,
        dated=not args.static,
        at_once=args.at_once,
        max_attempts=args.max_attempts,
        retry_seconds=args.retry_seconds,
        registry=registry if args.registry_records else None,
    )
    if not jobs:
        print(f"{namespace}: no tables to copy")
        return 0
    status = reports.with_spans(ledger.rows())
    for row in reports.progress_view(status).orderBy("table_name").toLocalIterator():
        print(*row, sep=" | ")
    for row in ledger.reconciliation().orderBy("table_name").toLocalIterator():
        print(row["mark"], row["table_name"], row["dst_rows"], "of", row["src_rows"])
    for row in reports.recent_messages(ledger.messages().where("level <> 'INFO'"), ["logged_at"]).collect():
        print(row["level"], row["table_name"], row["message"])
    summary = reports.run_summary(status).first()
    print(f"{namespace}: {summary}")
    return int(summary["failed_tables"] > 0)


if __name__ == "__main__":
    raise SystemExit(main())
