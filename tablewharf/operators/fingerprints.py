"""Do two tables hold the same rows? Fingerprints of key chunks, compared from the top down.

A chunk's fingerprint is its row count and sums of row hashes: it does not depend on the order of rows, sees
altered, lost and doubled rows, and fingerprints of chunks add up to that of the chunk above. So both tables are read once,
a tree of sums is compared level by level, and only the rows of leaves that differ are compared themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewharf.functions.text import canonical_text, ref
from tablewharf.operators import chunks
from tablewharf.operators.ordering import store

FAN_OUT = 16
LEAVES = 4096
SUMS = ("rows", "sum_a", "sum_b")


def row_hashes(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of a row's values in canonical text, so that typed and loaded rows agree.

    A NULL differs from every text, and columns are told apart by their order.
    """
    parts = [F.struct(canonical_text(f.name, f.dataType).isNull(), canonical_text(f.name, f.dataType)) for f in df.schema.fields]
    return [F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)") for seed in (1, 2)]


def chunk_fingerprints(df: DataFrame, chunk: Column) -> DataFrame:
    """``chunk, rows, sum_a, sum_b`` of every chunk, from one aggregate that combines map-side."""
    first, second = row_hashes(df)
    hashed = df.select(chunk.cast("bigint").alias("chunk"), first.alias("a"), second.alias("b"))
    return hashed.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))


def differing_chunks(source: DataFrame, destination: DataFrame, leaves: int, fan_out: int = FAN_OUT) -> DataFrame:
    """``chunk, source_rows, destination_rows`` of the leaves whose fingerprints differ.

    Both sides hold fingerprints of leaves from 0 to below ``leaves``; chunks outside of it (rows without a key, or beyond the
    source's keys) are compared directly. A level sums up ``fan_out`` children; below
    nodes that agree nothing is looked at. The walk reads the stored fingerprints only, never the tables.
    """
    sides = []
    for side, sign in ((source, 1), (destination, -1)):
        counts = [F.col("rows").alias("source_rows") if sign > 0 else F.lit(0).cast("bigint").alias("source_rows"),
                  F.col("rows").alias("destination_rows") if sign < 0 else F.lit(0).cast("bigint").alias("destination_rows")]
        sides.append(side.select("chunk", *counts, *[(F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in SUMS]))
    # What the sides do not share remains of each sum.
    both = sides[0].unionByName(sides[1]).groupBy("chunk").agg(
        *[F.sum(c).alias(c) for c in ("source_rows", "destination_rows", *SUMS)]
    )
    both = store(both, "fingerprints")
    depth, width = 0, 1
    while width < leaves:
        depth, width = depth + 1, width * fan_out
    inside = both.where(F.col("chunk").between(0, leaves - 1))
    nodes: DataFrame | None = None
    for level in range(depth, -1, -1):
        node = F.call_function("div", F.col("chunk"), F.lit(fan_out**level).cast("bigint"))
        looked = inside.withColumn("node", node)
        if nodes is not None:
            above = F.call_function("div", F.col("node"), F.lit(fan_out).cast("bigint"))
            looked = looked.withColumn("above", above).join(nodes, "above", "left_semi")
        sums = looked.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("source_rows", "destination_rows", *SUMS)])
        differ = " or ".join(f"{c} <> 0" for c in SUMS)
        found = store(sums.where(differ), "differing-nodes")
        if level == 0 or found.isEmpty():
            break
        nodes = found.select(F.col("node").alias("above"))
    outside = both.where(~F.coalesce(F.col("chunk").between(0, leaves - 1), F.lit(False))).where(" or ".join(f"{c} <> 0" for c in SUMS))
    columns = [F.col(c).cast("bigint").alias(c) for c in ("source_rows", "destination_rows")]
    leaves_found = found.select(F.col("node").alias("chunk"), *columns) if level == 0 else found.limit(0).select(F.col("node").alias("chunk"), *columns)
    return leaves_found.union(outside.select("chunk", *columns))


def differing_rows(source: DataFrame, destination: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that differ, by key in canonical text: ``key..., kind, source_rows, destination_rows``.

    ``lost``: the key is in the source only; ``surplus``: in the destination only; ``doubled``: the destination holds
    more rows of it; ``missing``: fewer; ``changed``: as many, but with other values.
    """
    names = [f"key{i}" for i in range(len(key))]

    def counted(df: DataFrame, side: str) -> DataFrame:
        first, second = row_hashes(df)
        keys = [canonical_text(k, df.schema[k].dataType).alias(n) for k, n in zip(key, names)]
        rows = df.select(*keys, first.alias("a"), second.alias("b"))
        return rows.groupBy(*names).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"), F.sum("a").alias(f"{side}_a"), F.sum("b").alias(f"{side}_b")
        )

    left = counted(source, "source").withColumn("whole_key", F.struct(*names))
    right = counted(destination, "destination").select(F.struct(*names).alias("whole_key"), "destination_rows", "destination_a", "destination_b")
    both = left.drop(*names).join(right, "whole_key", "full_outer")
    zero = F.lit(0).cast("bigint")
    s, d = F.coalesce("source_rows", zero), F.coalesce("destination_rows", zero)
    same = F.col("source_a").eqNullSafe(F.col("destination_a")) & F.col("source_b").eqNullSafe(F.col("destination_b"))
    kind = F.when(d == 0, "lost").when(s == 0, "surplus").when(d > s, "doubled").when(d < s, "missing").otherwise("changed")
    keys = [F.col("whole_key").getField(n).alias(k) for n, k in zip(names, key)]
    return both.where(~(same & (s == d))).select(*keys, kind.alias("kind"), s.alias("source_rows"), d.alias("destination_rows"))


def _leaf(source: DataFrame, df: DataFrame, key: Sequence[str], leaves: int) -> Column:
    """The leaf of a row: its range of a single integer, date or time key of the source, else a hash of its key's text.

    Rows without a key get -1; so do keys below the source's, and keys above it get ``leaves``.
    """
    if len(key) == 1 and chunks._is_number_key(source, key):
        low, high, _ = chunks.key_bounds(source, key[0])
        chunk = chunks.chunk_of(df, key[0], low, high, leaves)
        return F.greatest(F.lit(-1).cast("bigint"), F.least(chunk, F.lit(leaves).cast("bigint")))
    texts = [F.struct(canonical_text(k, df.schema[k].dataType)) for k in key]
    return F.pmod(F.xxhash64(*texts), F.lit(leaves)).cast("bigint")


def reconcile_content(
    source: DataFrame, destination: DataFrame, key: Sequence[str], leaves: int = LEAVES, fan_out: int = FAN_OUT
) -> tuple[DataFrame, DataFrame]:
    """The leaves of two tables that differ, and their differing rows.

    The destination may hold the source's values as text; columns that only it has are ignored. Both tables are read once
    for the fingerprints, and once more to compare the rows of the leaves that differ, at most ``leaves + 2`` of them.
    """
    loaded = destination.select(
        *[ref(f.name).cast(f.dataType).alias(f.name) if f.name in key and chunks._is_number_key(source, [f.name]) else ref(f.name) for f in source.schema.fields]
    )
    sides = [(df, _leaf(source, df, key, leaves)) for df in (source, loaded)]
    differ = store(differing_chunks(*[chunk_fingerprints(df, leaf) for df, leaf in sides], leaves, fan_out), "differing-chunks")
    named = differ.select(F.col("chunk").alias("differing_leaf"))
    parts = [df.join(F.broadcast(named), leaf == F.col("differing_leaf"), "left_semi") for df, leaf in sides]
    return differ, differing_rows(*parts, key)
