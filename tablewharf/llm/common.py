"""Helpers that several operators share: components, input tables, the package on the workers."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.operators.ordering import store, with_prefix

__all__ = ["WORD", "components", "only_one", "ship", "store", "table", "with_prefix"]

# Words of the contracts: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of an edge list ``(a, b)``: ``(node, component)`` with the
    smallest reachable node, for every node of an edge.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components
    in MapReduce and Beyond", 2014) until every edge points to a root. Minima combine map-side
    and each round is stored, so a hub with very many edges costs one partial minimum per task.
    """
    tidy = F.col("a") != F.col("b")
    pairs = edges.where(tidy).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = store(pairs, purpose)
    while not _are_stars(pairs):
        both = pairs.union(pairs.select("v", "u").toDF("u", "v"))
        lowest = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.where("u <> v"), purpose)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("m").alias("v"), F.explode(F.array("u", "v")).alias("w"))
        small = small.select(F.col("w").alias("u"), "v").where("u <> v").distinct()
        pairs = store(small, purpose)
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", "v"))


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node either points to one root or is one."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.out").alias("points"), F.min("e.out").alias("least"))
    return nodes.where("points > 1 or (points = 1 and least = 0)").isEmpty()


_kept: dict[tuple, Any] = {}


def only_one(name: tuple, make: Callable[[], Any]) -> Any:
    """A large object that a worker process keeps between tasks. Workers are used again by later
    stages, so asking for another object lets the former go."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless their path has it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    application = spark.sparkContext.applicationId
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or application in _shipped:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="package-"), "tablewharf")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "tablewharf"))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
