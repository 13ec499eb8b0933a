"""Contiguous shards of near equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewharf.llm.common import store

SHARDS = 8


def byte_prefix(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``row_index``, ``before_size`` and ``total_size`` in the order given, from the totals of partitions.

    Rows are dealt into ranges of the order (and of their place in the input, so that even equal rows spread) and
    stored. One row for each partition, its rows and bytes, gives every partition its start; inside, a running sum is enough.
    """
    tied = rows.withColumn("place", F.monotonically_increasing_id())
    placed = store(tied.repartitionByRange(*order, "place").withColumn("part", F.spark_partition_id()), "shards")
    totals = placed.groupBy("part").agg(F.count(F.lit(1)).alias("part_rows"), F.sum("size").alias("part_size"))
    upto = Window.orderBy("part")  # over one row for each partition
    starts = totals.select(
        "part",
        (F.sum("part_rows").over(upto) - F.col("part_rows")).alias("first_row"),
        (F.sum("part_size").over(upto) - F.col("part_size")).alias("first_byte"),
        F.sum("part_size").over(Window.partitionBy()).alias("total_size"),
    )
    inside = Window.partitionBy("part").orderBy(*order, "place")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = placed.withColumns({"number": F.row_number().over(inside), "running": running}).join(starts, "part")
    return summed.select(
        *rows.columns,
        (F.col("first_row") + F.col("number") - 1).alias("row_index"),
        (F.col("first_byte") + F.col("running") - F.col("size")).alias("before_size"),
        "total_size",
    )


def byte_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Cut documents into ``shards`` contiguous runs of near equal size.

    A document's size is its UTF-8 bytes plus 1. The order is by a digest of the text and
    then by id, so equal texts stand together and are parted only where a cut falls into
    them; sorting by digest also mixes sources evenly. A document goes to the shard in
    which its middle byte falls, so each shard differs from its equal share by at most one
    document. Returns ``doc_id, size, text_crc32, shard, slot``; ``slot`` counts from 0 in each shard.

    A null text has no bytes (size 1, CRC 0) and differs in no way from an empty one; null and
    repeated ids are ordinary rows; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("digest"),
    )
    placed = byte_prefix(rows, ["digest", "doc_id"])
    shard = F.expr(f"((2 * before_size + size) * {shards}) div (2 * total_size)")
    cut = placed.select("doc_id", "size", "text_crc32", "row_index", shard.cast("int").alias("shard"))
    first = cut.groupBy("shard").agg(F.min("row_index").alias("first_index"))
    slot = (F.col("row_index") - F.col("first_index")).alias("slot")
    return cut.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", slot)
