"""Data quality as rows: null profiles, key checks and rows the target refuses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions.text import canonical_text, ref

# Limits of key and text columns in the usual relational destination.
MAX_KEY_CHARS = 255
MAX_TEXT_BYTES = 65535


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, nulls)`` for every column that has NULLs, from one aggregate."""
    counts = df.agg(
        *[F.count_if(ref(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("nulls"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(entries)).where("nulls > 0")


def key_check(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, rows with a NULL in the key, and the verdict.

    Only the key columns are read, and repeated keys combine before the shuffle.
    """
    per_key = df.groupBy(*[ref(k) for k in key]).agg(F.count(F.lit(1)).alias("copies"))
    has_null = reduce(lambda a, b: a | b, [ref(k).isNull() for k in key])
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count_if(~has_null).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("copies"))), F.lit(0))
        .cast("bigint")
        .alias("null_key_rows"),
    ).withColumn("is_key", F.col("total_rows") == F.col("distinct_keys"))


def _may_be_long(dtype: T.DataType) -> bool:
    return isinstance(
        dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    )


def refusal_reason(
    schema: T.StructType,
    key: Sequence[str] = (),
    max_text_bytes: int | None = None,
    max_key_chars: int | None = None,
) -> Column:
    """Why the destination would refuse a row; NULL when it would take it.

    Lengths are limited only where the caller states the destination's limits.
    The rules look at the text a value becomes, so they can run while columns
    still have their types.
    """
    checks = []
    for name in key:
        text = canonical_text(name, schema[name].dataType)
        checks.append(F.when(text.isNull(), F.lit(f"key {name} is null")))
        if max_key_chars is not None and _may_be_long(schema[name].dataType):
            too_long = F.char_length(text) > max_key_chars
            checks.append(F.when(too_long, F.lit(f"key {name} exceeds {max_key_chars} characters")))
    for field in schema.fields:
        if max_text_bytes is not None and field.name not in key and _may_be_long(field.dataType):
            # Text is measured as it is: only short texts stand for NULL.
            is_text = isinstance(field.dataType, T.StringType)
            text = ref(field.name) if is_text else canonical_text(field.name, field.dataType)
            too_big = F.octet_length(text) > max_text_bytes
            checks.append(F.when(too_big, F.lit(f"{field.name} exceeds {max_text_bytes} bytes")))
    return F.coalesce(*checks, F.lit(None).cast("string"))


def with_refusal_reason(
    df: DataFrame, key: Sequence[str] = (), name: str = "refusal_reason", **limits: int | None
) -> DataFrame:
    return df.withColumn(name, refusal_reason(df.schema, key, **limits))


def split_rows(
    df: DataFrame, key: Sequence[str] = (), **limits: int
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and refused rows with their reason."""
    marked = with_refusal_reason(df, key, **limits)
    accepted = marked.where(F.col("refusal_reason").isNull()).drop("refusal_reason")
    return accepted, marked.where(F.col("refusal_reason").isNotNull())
