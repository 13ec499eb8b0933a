"""Value cleaning in its fixed order: distinct, trim, null-fill, NaN/Inf repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions import text as X
from tablewharf.functions.text import ref


def _comparable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _comparable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_comparable(f.dataType) for f in dtype.fields)
    return True


def _holds_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_variant(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_variant(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.VariantType)


def comparable_values(df: DataFrame) -> DataFrame:
    """Maps and variants as JSON text, since rows that hold them have no order."""
    return df.select(
        *[
            ref(f.name) if _comparable(f.dataType) else F.to_json(ref(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop fully identical rows; NULL equals NULL and NaN equals NaN.

    Copies collapse in the map-side half of the aggregation, so even a row that
    makes up a third of the table sends one record per task over the network.
    """
    if all(_comparable(f.dataType) for f in df.schema.fields):
        return df.dropDuplicates()
    # Set operations refuse maps while grouping accepts them. Variants cannot be grouped: their JSON stands for them.
    keys = [f"key{i}" for i in range(len(df.columns))]
    values = [F.to_json(ref(f.name)) if _holds_variant(f.dataType) else ref(f.name) for f in df.schema.fields]
    held = [F.any_value(ref(f.name)).alias(f"held{i}") for i, f in enumerate(df.schema.fields) if _holds_variant(f.dataType)]
    grouped = df.groupBy(*[v.alias(k) for v, k in zip(values, keys)]).agg(F.count(F.lit(1)), *held)
    return grouped.select(
        *[F.col(f"held{i}" if _holds_variant(f.dataType) else f"key{i}").alias(f.name) for i, f in enumerate(df.schema.fields)]
    )


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and how many rows distinct removes."""
    values = [F.to_json(ref(f.name)).alias(f.name) if _holds_variant(f.dataType) else ref(f.name) for f in df.schema.fields]
    per_row = df.groupBy(*values).agg(F.count(F.lit(1)).alias("copies"))
    return per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
    ).select("rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("removed"))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            X.trim_text(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def fill_numeric_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """NULL becomes ``value`` in integer and float columns; decimals keep NULL."""
    return df.select(
        *[
            X.fill_null_number(ref(f.name), f.dataType, value).alias(f.name)
            if X.is_integer(f.dataType) or X.is_float(f.dataType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def zero_non_finite(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            X.non_finite_to_zero(ref(f.name), f.dataType).alias(f.name)
            if X.is_float(f.dataType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def null_non_finite(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            X.non_finite_to_null(ref(f.name)).alias(f.name) if X.is_float(f.dataType) else ref(f.name)
            for f in df.schema.fields
        ]
    )


def clean_values(df: DataFrame, fill_numeric: float | None = 0, keys: Sequence[str] = ()) -> DataFrame:
    """Trim, null-fill and NaN/Inf repair of all columns in a single projection.

    ``fill_numeric=None`` keeps numeric NULLs. Columns in ``keys`` are only trimmed: a row without a key must
    not become the row whose key is 0.
    """

    def cleaned(field: T.StructField):
        c, dtype = ref(field.name), field.dataType
        if isinstance(dtype, T.StringType):
            return X.trim_text(field.name).alias(field.name)
        if field.name in keys:
            return c
        if X.is_integer(dtype) and fill_numeric is not None:
            return X.fill_null_number(c, dtype, fill_numeric).alias(field.name)
        if X.is_float(dtype):
            filled = c if fill_numeric is None else X.fill_null_number(c, dtype, fill_numeric)
            return X.non_finite_to_zero(filled, dtype).alias(field.name)
        return c

    return df.select(*[cleaned(f) for f in df.schema.fields])


def text_table(df: DataFrame) -> DataFrame:
    """Every column as destination text: one projection, all ``StringType``."""
    return df.select(
        *[X.canonical_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields]
    )
