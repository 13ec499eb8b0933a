"""Replace-load of registry records into a table with a fixed set of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewharf.operators.chunks import with_dense_id
from tablewharf.operators.selection import GENERATED_COLUMNS, aligned_columns, matching_fields
from tablewharf.sinks.snapshots import full_refresh


def registry_table(
    records: DataFrame, columns: Sequence[str], dense_by: str | Sequence[str] | None = None
) -> DataFrame:
    """Records in the shape of the registry table.

    Matching fields become text, columns without a field are NULL, other fields
    are left out. ``id`` is unique but has gaps; with ``dense_by``, a unique
    record field, it counts 1, 2, 3, … in that field's order.
    """
    if dense_by:
        numbered = with_dense_id(records, dense_by, name="record_number")
    else:
        numbered = records.withColumn("record_number", F.monotonically_increasing_id() + 1)
    fields = dict(zip(matching_fields(records, columns), aligned_columns(records, columns)))
    body = [
        fields.get(name, F.lit(None).cast("string")).alias(name)
        for name in columns
        if name not in GENERATED_COLUMNS
    ]
    return numbered.select(F.col("record_number").cast("bigint").alias("id"), *body)


def load_registry(
    records: DataFrame,
    columns: Sequence[str],
    namespace: str,
    table: str,
    folder: str,
    dense_by: str | None = None,
) -> bool:
    """Replace the registry table; without records nothing changes and it is False."""
    if records.isEmpty():
        return False
    full_refresh(registry_table(records, columns, dense_by), namespace, table, folder)
    return True
