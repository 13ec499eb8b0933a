"""Queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL twin."""

    def add(query: Query) -> Query:
        CHECKS[query.__name__] = Check(query, sql)
        return query

    return add


def load_all() -> dict[str, Check]:
    from checks import cleaning, jobs, loading, reports, scans  # noqa: F401

    return CHECKS
