"""Which tables to copy and which record fields have a home in the target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewharf.functions.names import matches_glob, split_names
from tablewharf.functions.text import canonical_text, ref

# Columns the destination fills in by itself.
GENERATED_COLUMNS = ("id", "loaded_at")


def _names(tables: DataFrame, text: str) -> DataFrame:
    session = tables.sparkSession
    listed = session.range(1).select(F.explode(split_names(F.lit(text))).alias("table_name"))
    return listed.where("table_name != ''").distinct()


def select_tables(
    tables: DataFrame, include: str = "", exclude: str = "", globs: bool = False
) -> DataFrame:
    """Apply comma-separated include and exclude lists; an empty include takes all.

    A name on both lists is excluded. ``globs`` reads the entries as patterns.
    """
    chosen = tables
    if globs:
        for text, keep in ((include, True), (exclude, False)):
            patterns = [p.strip() for p in text.split(",") if p.strip()]
            if patterns:
                hits = [matches_glob(F.col("table_name"), p) for p in patterns]
                any_hit = reduce(lambda a, b: a | b, hits)
                chosen = chosen.where(any_hit if keep else ~any_hit)
        return chosen
    if include.strip():
        chosen = chosen.join(_names(tables, include), "table_name", "left_semi")
    if exclude.strip():
        chosen = chosen.join(_names(tables, exclude), "table_name", "left_anti")
    return chosen.select(*[ref(c) for c in tables.columns])


def matching_fields(records: DataFrame, target_columns: Sequence[str]) -> list[str]:
    """Record fields, in record order, that the target has and does not generate."""
    wanted = set(target_columns) - set(GENERATED_COLUMNS)
    return [c for c in records.columns if c in wanted]


def aligned_columns(records: DataFrame, target_columns: Sequence[str]) -> list[Column]:
    """Matching fields as the text that tables get; texts stay as they are, NULL stays NULL."""

    def as_text(name: str) -> Column:
        dtype = records.schema[name].dataType
        return (ref(name) if isinstance(dtype, StringType) else canonical_text(name, dtype)).alias(name)

    return [as_text(name) for name in matching_fields(records, target_columns)]


def align(records: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    return records.select(*aligned_columns(records, target_columns))


def unmatched_fields(records: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Fields without a target column, with how many records fill them."""
    wanted = set(target_columns) - set(GENERATED_COLUMNS)
    missing = [c for c in records.columns if c not in wanted]
    if not missing:
        session = records.sparkSession
        return session.createDataFrame([], "field string, filled_records bigint")
    counts = records.agg(
        *[F.count(ref(c)).alias(f"c{i}") for i, c in enumerate(missing)]
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(f"c{i}").alias("filled_records"))
            for i, c in enumerate(missing)
        ]
    )
    return counts.select(F.inline(entries))
