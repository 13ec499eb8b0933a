"""Table sizing, chunk manifests and exact running totals without hot tasks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewharf.functions import text as X
from tablewharf.functions.text import percent, ref
from tablewharf.operators.ordering import with_prefix

# Size tiers as (rows below, tier, batch rows).
SIZE_TIERS = (
    (1_000, "tiny", 1000),
    (10_000, "small", 2000),
    (100_000, "medium", 5000),
    (1_000_000, "large", 5000),
    (None, "huge", 5000),
)
# Bytes of values, about, that a range of rows holds at most.
CELL_BYTES = 64 << 20


def size_tier(total_rows: int) -> dict:
    """The tier of one table on the driver, for batch options and reports."""
    for below, tier, batch in SIZE_TIERS:
        if below is None or total_rows < below:
            return {"tier": tier, "batch_rows": batch}
    raise AssertionError("the last tier has no upper bound")


def with_size_tier(df: DataFrame, total_rows: str = "total_rows") -> DataFrame:
    """Add tier and batch rows to rows that carry a row count."""
    rows = ref(total_rows)

    def pick(position: int) -> Column:
        chain = None
        for entry in SIZE_TIERS:
            if entry[0] is None:
                return chain.otherwise(F.lit(entry[position]))
            condition = rows < entry[0]
            value = F.lit(entry[position])
            chain = F.when(condition, value) if chain is None else chain.when(condition, value)

    return df.select(
        *[ref(c) for c in df.columns],
        pick(1).alias("tier"),
        pick(2).cast("int").alias("batch_rows"),
    )


def _is_number_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ranges of the key can be cut by arithmetic: one integer, date or time."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, kinds)


def _placed(df: DataFrame, order_by: Sequence[str], group: Sequence[str], amount: Column) -> DataFrame:
    """Rows as ``record`` with their number and running total in order of any keys."""
    rows = df.select(
        F.struct(*[ref(c) for c in df.columns]).alias("record"),
        F.struct(F.lit(0).alias("all"), *[ref(g) for g in group]).alias("group_key"),
        *[ref(c).alias(f"order{i}") for i, c in enumerate(order_by)],
        amount.cast("bigint").alias("amount"),
    )
    return with_prefix(rows, ["group_key", *[f"order{i}" for i in range(len(order_by))]], ["amount"], "order")


def _record(df: DataFrame) -> list[Column]:
    return [F.col("record").getField(c).alias(c) for c in df.columns]


def even_manifest(df: DataFrame, keys: Sequence[str], chunks: int) -> DataFrame:
    """``(chunk, rows_in_chunk, min_key, max_key)`` in chunks of equal rows, by keys of any orderable type.

    ``min_key`` and ``max_key`` are structs of the keys. Rows are numbered in key order range by range.
    """
    number = _placed(df.select(*[ref(k) for k in keys]), keys, (), F.lit(1))
    key = F.struct(*[F.col("record").getField(k).alias(k) for k in keys])
    chunk = F.call_function("div", F.col("row_index") * chunks, F.col("total_amount"))
    return number.groupBy(chunk.cast("bigint").alias("chunk")).agg(
        F.count(F.lit(1)).alias("rows_in_chunk"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    )


def key_number(df: DataFrame, key: str) -> Column:
    """An integer, date or time key as an order-preserving bigint."""
    dtype = df.schema[key].dataType
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return ref(key).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(ref(key)).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(ref(key))
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, ref(key))
    raise TypeError(f"{key}: chunking needs an integer, date or timestamp key, not {dtype}")


def key_bounds(df: DataFrame, key: str) -> tuple[int, int, int]:
    """Least key, greatest key and row count, from the key column alone."""
    number = key_number(df, key)
    low, high, rows = df.agg(F.min(number), F.max(number), F.count(F.lit(1))).first()
    return (low or 0, high or 0, rows)


def chunk_of(df: DataFrame, key: str, low: int, high: int, chunks: int) -> Column:
    """The number of the equal-width key range a row falls into, from 0.

    Plain arithmetic on the key: no shuffle, no sort, and the same answer
    whenever and wherever a task is run again. Rows without a key get -1.
    """
    number = key_number(df, key)
    width = max(1, -(-(high - low + 1) // max(1, chunks)))
    if high - low >= 2**63:
        number, width = number.cast("decimal(20,0)"), Decimal(width)
    chunk = F.call_function("div", number - F.lit(low), F.lit(width))
    return F.coalesce(chunk.cast("bigint"), F.lit(-1).cast("bigint"))


def with_chunk(df: DataFrame, key: str, chunks: int, name: str = "chunk") -> DataFrame:
    low, high, _ = key_bounds(df, key)
    return df.withColumn(name, chunk_of(df, key, low, high, chunks))


def chunk_manifest(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """``(chunk, rows_in_chunk, min_key, max_key)`` for every chunk that has rows."""
    return (
        with_chunk(df.select(ref(key)), key, chunks)
        .groupBy("chunk")
        .agg(
            F.count(F.lit(1)).alias("rows_in_chunk"),
            F.min(ref(key)).alias("min_key"),
            F.max(ref(key)).alias("max_key"),
        )
    )


def chunk_progress(source: DataFrame, loaded: DataFrame, key: str, chunks: int) -> DataFrame:
    """Per chunk: rows of the source, rows already loaded, percent and status.

    Chunks span the source's keys. Loaded rows beyond them have chunks of their own,
    below 0 or after the last, with no source rows and the status ``surplus``; so has any chunk
    that holds more rows than the source.
    """
    low, high, _ = key_bounds(source, key)

    def rows_per_chunk(df: DataFrame, name: str) -> DataFrame:
        chunk = chunk_of(df, key, low, high, chunks).alias("chunk")
        return df.groupBy(chunk).agg(F.count(F.lit(1)).alias(name))

    done = F.coalesce(F.col("done"), F.lit(0).cast("bigint"))
    total = F.coalesce(F.col("total_rows"), F.lit(0).cast("bigint"))
    status = F.when(done > total, "surplus").when(done == total, "completed").otherwise("running")
    return (
        rows_per_chunk(source, "total_rows")
        .join(rows_per_chunk(loaded, "done"), "chunk", "full_outer")
        .select(
            "chunk",
            total.alias("total_rows"),
            done.alias("rows_processed"),
            percent(done, total).alias("progress"),
            status.alias("status"),
        )
    )


def _literal(value: object, df: DataFrame, key: str) -> Column:
    """A key value as a literal; zone-free times go through text to stay so."""
    dtype = df.schema[key].dataType
    return F.lit(str(value)).cast(dtype) if isinstance(dtype, T.TimestampNTZType) else F.lit(value)


def read_page(
    df: DataFrame, key: str | Sequence[str], offset: int, limit: int, rows_per_chunk: int = 1_000_000
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the table in order of a unique key.

    A key of several columns, or of text or decimals, has no arithmetic ranges: all rows are then numbered in
    key order, range by range, and the page is cut by number.

    Sorting to a deep offset keeps every skipped row in memory. Chunk counts
    tell which key ranges the page touches, so only those are read (the range
    reaches the scan as a pushed filter). Their rows are numbered range by range, so
    a page of any width is cut without gathering it in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not _is_number_key(df, keys):
        placed = _placed(df, keys, (), F.lit(1))
        page = placed.where(F.col("row_index").between(offset, offset + limit - 1))
        return page.select(*_record(df)).orderBy(*[ref(k) for k in keys])
    key = keys[0]
    low, high, rows = key_bounds(df, key)
    chunks = max(1, -(-rows // rows_per_chunk))
    key_column = ref(key)
    per_chunk = df.groupBy(chunk_of(df, key, low, high, chunks).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key_column).alias("first"), F.max(key_column).alias("last")
    )
    # One row per chunk: small enough for a running total over all of them.
    ends = per_chunk.withColumn("end", F.sum("n").over(Window.orderBy("chunk")))
    before = F.col("end") - F.col("n")
    first, last, skipped, chunk, inside_rows = (
        ends.where((F.col("end") > offset) & (before < offset + limit))
        .agg(F.min("first"), F.max("last"), F.min(before), F.min("chunk"), F.sum("n"))
        .first()
    )
    if chunk is None:
        return df.limit(0)
    inside = key_column.between(_literal(first, df, key), _literal(last, df, key))
    if chunk == -1:  # rows without a key sort first
        inside = key_column.isNull() if first is None else inside | key_column.isNull()
    found = df.where(inside)
    if chunk >= 0 and 2 * rows_per_chunk < inside_rows < rows:
        # Values cluster in these ranges: look again within their own bounds.
        return read_page(found, key, offset - skipped, limit, rows_per_chunk)
    place = X.spare_name(df.columns, "place")
    numbered = with_dense_id(found, key, rows_per_chunk, place)
    page = numbered.where(ref(place).between(offset - skipped + 1, offset - skipped + limit))
    return page.drop(place).orderBy(key_column)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values, about: texts by their length, nested values by that of their text, others as 8."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        value = ref(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = value.cast("string")
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.lit(8)
            continue
        total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total


def with_cells(df: DataFrame, key: str, rows_per_cell: int, name: str = "cell") -> DataFrame:
    """Add a struct that orders like a unique ``key`` and groups few rows each, of few bytes.

    Ranges of equal width come first. Where values cluster or rows are long, a range may hold far
    more than ``rows_per_cell`` rows or ``CELL_BYTES``; such a range is cut again within its own bounds, until
    none is too full. Evenly spread keys of rows of like length need no second cut. Rows of one key stay together.
    """
    key_as_number = key_number(df, key)
    low, high, rows, held = df.agg(
        F.min(key_as_number), F.max(key_as_number), F.count(F.lit(1)), F.sum(_row_bytes(df))
    ).first()
    low, high, limit = low or 0, high or 0, rows_per_cell
    cells = max(1, -(-rows // limit), -(-(held or 0) // CELL_BYTES))
    taken = list(df.columns)
    number, level = X.spare_name(taken, "key_number"), X.spare_name(taken, "level")
    levels = [f"{level}0"]
    cut = df.withColumns(
        {levels[0]: chunk_of(df, key, low, high, cells), number: key_number(df, key)}
    )
    while cells > 1:
        per_cell = cut.groupBy(*levels).agg(
            F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.sum(_row_bytes(df)).alias("bytes")
        )
        too_full = (F.col("n") > 2 * limit) | (F.col("bytes") > 2 * CELL_BYTES)
        full = per_cell.where(too_full & (F.col("hi") > F.col("lo")))
        if full.isEmpty():
            break
        parts = F.greatest(*[F.call_function("div", F.col(c), F.lit(most)) for c, most in (("n", limit), ("bytes", CELL_BYTES))]) + 1
        start, width = X.spare_name(taken, "cell_start"), X.spare_name(taken, "cell_width")
        bounds = full.select(
            *levels,
            F.col("lo").alias(start),
            (F.call_function("div", F.col("hi") - F.col("lo"), parts) + 1).alias(width),
        )
        # One row for each range that is too full: rows need not meet by range to be cut.
        cut = cut.join(F.broadcast(bounds), levels, "left")
        finer = F.call_function("div", ref(number) - ref(start), ref(width))
        levels = [*levels, f"{level}{len(levels)}"]
        cut = cut.withColumn(levels[-1], F.coalesce(finer, F.lit(0).cast("bigint")))
        cut = cut.drop(start, width)
    return cut.select(*[ref(c) for c in df.columns], F.struct(*levels).alias(name))


def with_running_total(
    df: DataFrame,
    value: Column,
    order_by: str | Sequence[str],
    group: Sequence[str] = (),
    rows_per_cell: int = 1_000_000,
    name: str = "running_total",
) -> DataFrame:
    """Exact running sum of ``value`` by a unique ``order_by`` within ``group``.

    For keys that have no arithmetic ranges (text, decimals, several columns) ``value`` must be whole.

    A window over a whole group would put a hot group (or, without a group, the
    whole table) into one task. Here every group is cut into key ranges; the
    range sums are small enough to accumulate by a window, and each row adds the
    sum within its own range. No task holds more than one range of one group,
    and the number of ranges grows with the table.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    if not _is_number_key(df, keys):
        placed = _placed(df, keys, group, value)
        first = placed.groupBy("group_key").agg(F.min("before_amount").alias("group_start"))
        upto = F.col("before_amount") + F.col("amount") - F.col("group_start")
        return placed.join(first, "group_key").select(*_record(df), upto.alias(name))
    order_by = keys[0]
    columns = [ref(c) for c in df.columns]
    celled = with_cells(df, order_by, rows_per_cell, X.spare_name(df.columns, "cell"))
    cell = ref(celled.columns[-1])
    # A struct is never NULL, so it joins and partitions NULL groups like others.
    group_key = F.struct(F.lit(0).alias("all"), *[ref(g) for g in group])
    base = celled.select(
        *columns, group_key.alias("group_key"), cell.alias("cell"), value.alias("amount")
    )
    before = Window.partitionBy("group_key").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        base.groupBy("group_key", "cell")
        .agg(F.sum("amount").alias("cell_sum"))
        .select("group_key", "cell", F.sum("cell_sum").over(before).alias("start"))
    )
    # The window comes first: the join then finds its rows already partitioned
    # and sorted by group and range, and the table is shuffled once.
    within = Window.partitionBy("group_key", "cell").orderBy(ref(order_by)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = base.select(
        *columns, "group_key", "cell", F.sum("amount").over(within).alias("sum_in_cell")
    )
    total = F.col("sum_in_cell") + F.coalesce(F.col("start"), F.lit(0))
    return summed.join(starts, ["group_key", "cell"], "inner").select(*columns, total.alias(name))


def with_byte_batches(
    df: DataFrame,
    text: Sequence[str],
    order_by: str | Sequence[str],
    max_bytes: int,
    group: Sequence[str] = (),
    rows_per_cell: int = 1_000_000,
) -> DataFrame:
    """Number batches so that each starts where another ``max_bytes`` are full."""
    size = sum((F.coalesce(F.octet_length(ref(c)), F.lit(0)).cast("bigint") for c in text), F.lit(0))
    counted = with_running_total(df, size, order_by, group, rows_per_cell, "running_bytes")
    return counted.select(
        *[ref(c) for c in df.columns],
        "running_bytes",
        F.floor(F.col("running_bytes") / max_bytes).cast("bigint").alias("batch_id"),
    )


def with_dense_id(
    df: DataFrame, order_by: str | Sequence[str], rows_per_cell: int = 1_000_000, name: str = "id"
) -> DataFrame:
    """1, 2, 3, … in key order over the whole table, without a global sort task."""
    return with_running_total(df, F.lit(1).cast("bigint"), order_by, (), rows_per_cell, name)
