"""Registry records: exported JSON read against a declared schema."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions.text import ref


def read_records(
    spark: SparkSession, path: str, schema: T.StructType | str, array: bool = False
) -> DataFrame:
    """Records of exported JSON files; ``array`` for one JSON array per file.

    The declared schema replaces "the fields of the first record": no
    inference pass, and a field that only later records carry is not lost.
    Line-delimited files split across tasks; a file holding one array does not.
    """
    return spark.read.schema(schema).option("multiLine", str(array).lower()).json(path)


def union_of_fields(df: DataFrame, column: str) -> T.StructType:
    """Every field that any record has, with the type that all its values fit, from one aggregate over the JSON texts.

    Each text becomes a VARIANT, and Spark's variant schemas merge map-side, so a field that few or late
    records carry is found like any other. Whole numbers are ``bigint`` (beyond 18 digits ``decimal``), others
    ``double`` (beyond 15 digits ``decimal``); fields whose values are of different kinds, or always null, are text. Texts that are no
    JSON objects are left out; without records there are no fields.
    """
    parsed = df.select(F.try_parse_json(ref(column).cast("string")).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
    found = parsed.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    types = re.sub(r"(: |<)OBJECT<>", r"\1STRING", "STRUCT<" + found.removeprefix("OBJECT<"))
    types = re.sub(r"(: |<)OBJECT<", r"\1STRUCT<", types)
    types = re.sub(r"(: |<)(?:VOID|VARIANT)(?=[,>])", r"\1STRING", types)

    def number(match: re.Match[str]) -> str:
        digits, fraction = int(match[2]), int(match[3])
        kind = "BIGINT" if fraction == 0 and digits <= 18 else "DOUBLE" if fraction and digits <= 15 else match[0][len(match[1]) :]
        return match[1] + kind

    types = re.sub(r"(: |<)DECIMAL\((\d+),(\d+)\)", number, types)
    return T.DataType.fromDDL(types)


def parse_records(df: DataFrame, column: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records kept as JSON text in a column, next to the other columns.

    Without a schema the records' own fields are found first, by one more pass.
    """
    schema = union_of_fields(df, column) if schema is None else schema
    others = [ref(c) for c in df.columns if c != column]
    parsed = df.select(*others, F.from_json(ref(column), schema).alias("record"))
    return parsed.select(*others, "record.*")
