"""Tables of a relational database, read in parallel key ranges.

Spark reads and writes over JDBC through the driver jar that the cluster
supplies. Filters, column choice, limits and counts are pushed to the database.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions.text import ref
from tablewharf.operators.chunks import size_tier
from tablewharf.operators.ordering import with_prefix


def _quoted(name: str, quote: str) -> str:
    return quote + name.replace(quote, quote * 2) + quote


# Rows that one connection reads or writes.
ROWS_PER_PARTITION = 500_000


def partitions(total_rows: int) -> int:
    return max(1, -(-total_rows // ROWS_PER_PARTITION))


def read_options(total_rows: int) -> dict[str, str]:
    """Fetch size, and as many partitions as the rows need."""
    return {
        "fetchsize": str(size_tier(total_rows)["batch_rows"]),
        "numPartitions": str(partitions(total_rows)),
        "pushDownAggregate": "true",
        "pushDownLimit": "true",
        "pushDownOffset": "true",
    }


def write_options(total_rows: int) -> dict[str, str]:
    return {"batchsize": str(size_tier(total_rows)["batch_rows"]), "numPartitions": str(partitions(total_rows))}


def row_count(spark: SparkSession, options: Mapping[str, str], table: str) -> int:
    """COUNT(*), computed by the database."""
    return spark.read.format("jdbc").options(**options, dbtable=table).load().count()


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    key: str | None = None,
    bounds: tuple[str, str] | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """A table, split by ``key`` between ``bounds`` where both are known.

    Ranges of a key never overlap or leave gaps, unlike unordered pages.
    """
    reader = spark.read.format("jdbc").options(**options, dbtable=table)
    if total_rows is not None:
        reader = reader.options(**read_options(total_rows))
    if key and bounds and total_rows:
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1]
        )
    return reader.load()


def range_predicates(
    key: str, starts: Sequence[object], quote: str = "`"
) -> list[str]:
    """Adjoining WHERE clauses from ascending range starts, e.g. a chunk manifest.

    Unlike equal-width splits these follow the rows, so a dense key range does
    not end up in one reader. NULL keys go to the first range.
    """

    def literal(value: object) -> str:
        if isinstance(value, (int, float)):
            return str(value)
        return "'" + str(value).replace("'", "''") + "'"

    column = _quoted(key, quote)
    cuts = [literal(s) for s in starts[1:]]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= {cuts[-1]}"]


def tuple_predicates(key: Sequence[str], starts: Sequence[Sequence[object]], quote: str = "`") -> list[str]:
    """WHERE clauses that deal every row into exactly one range of a key of several columns, of texts or numbers.

    ``starts`` are key values, as from :func:`key_starts`. A range holds the rows from its own start up to
    the next one, column by column; the first holds all before, and rows with a NULL in the key. Each clause says "from this
    start on, but not from the next", and the comparison is never unknown, so ranges adjoin without gaps
    whatever the order of texts in the database is, as long as it is one order.
    """

    def literal(value: object) -> str:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            return "'" + str(value).replace("'", "''") + "'"
        return str(value)

    columns = [_quoted(k, quote) for k in key]

    def from_on(start: Sequence[object]) -> str:
        parts = []
        for i, (column, value) in enumerate(zip(columns, start)):
            equal = [f"{c} = {literal(v)}" for c, v in zip(columns[:i], start)]
            sign = ">=" if i == len(columns) - 1 else ">"
            parts.append(" AND ".join([*equal, f"{column} {sign} {literal(value)}"]))
        given = " AND ".join(f"{c} IS NOT NULL" for c in columns)
        return f"({given} AND ({' OR '.join(f'({p})' for p in parts)}))"

    whole = [from_on(s) for s in starts]
    if not whole:
        return ["1 = 1"]
    between = [f"{a} AND NOT {b}" for a, b in zip(whole, whole[1:])]
    return [f"NOT {whole[0]}", *between, whole[-1]]


def key_starts(keys: DataFrame, key: Sequence[str], ranges: int, sample: int = 1000) -> list[tuple]:
    """Key values at which about equal ranges start, from a sample of ``sample`` keys for each range.

    The sample is drawn by a hash of the key and sorted by Spark; only the starts come to the driver.
    """
    wanted = keys.select(*[ref(k).alias(f"k{i}") for i, k in enumerate(key)]).dropna()
    rows = wanted.count()
    if ranges <= 1 or rows == 0:
        return []
    share = min(1.0, ranges * sample / rows)
    names = wanted.columns
    drawn = wanted.where(F.pmod(F.xxhash64(*names), F.lit(1 << 30)) <= int(share * (1 << 30))).distinct()
    placed = with_prefix(drawn, names, [], "key-starts")
    total = placed.count()
    step = max(1, -(-total // ranges))
    found = placed.where((F.col("row_index") > 0) & (F.col("row_index") % step == 0)).orderBy("row_index")
    return [tuple(r[n] for n in names) for r in found.collect()]


def read_ranges(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: Mapping[str, str]
) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties))


def base_tables(spark: SparkSession, options: Mapping[str, str], schema: str) -> DataFrame:
    """Base tables of one schema by name, from the information schema."""
    tables = spark.read.format("jdbc").options(**options, dbtable="information_schema.tables").load()
    lowered = tables.select(*[F.col(c).alias(c.lower()) for c in tables.columns])
    return (
        lowered.where((F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE"))
        .select("table_schema", "table_name")
        .orderBy("table_name")
    )


def key_metadata(spark: SparkSession, options: Mapping[str, str], schema: str):
    """The two metadata tables from which ``catalog.primary_keys`` finds keys."""

    def metadata(name: str) -> DataFrame:
        df = spark.read.format("jdbc").options(**options, dbtable=f"information_schema.{name}").load()
        lowered = df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
        return lowered.where(F.col("table_schema") == schema)

    return metadata("table_constraints"), metadata("key_column_usage")
