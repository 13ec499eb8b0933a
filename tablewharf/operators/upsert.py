"""Key-based loading: one winner per key, merges and appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions import text as X
from tablewharf.functions.text import ref
from tablewharf.operators.ordering import store

# Bits of the map of repeated keys: at most so many divided by 8 bytes reach every task (4 MiB).
BITMAP_BITS = 1 << 25
# Fixed value: bits that Spark's bitmap functions keep in one value.
PAGE_BITS = 32_768


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    key: Sequence[str | Column],
    order_by: Sequence[str] = (),
    collation: str | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """Keep the row a sequence of upserts would leave behind for each key.

    The winner is the greatest row by ``order_by``, then by the remaining
    columns, so the result never depends on how rows were spread over tasks.
    The greatest struct combines map-side: a hot key costs one row per task in
    the shuffle instead of its whole group in one task.

    ``collation`` (for example ``UNICODE_CI``) compares keys without regard to
    case, as a case-insensitive destination would. ``count_as`` adds the number
    of rows each winner stands for.
    """
    rest = [c for c in df.columns if c not in order_by]
    ordered = [*order_by, *rest]
    whole = F.struct(*[ref(c) for c in ordered])
    if all(_orderable(df.schema[c].dataType) for c in ordered):
        winner = F.max(whole).alias("winner")
    else:  # maps have no order of their own: their JSON decides
        rank = [ref(c) if _orderable(df.schema[c].dataType) else F.to_json(ref(c)) for c in ordered]
        winner = F.max_by(whole, F.struct(*rank)).alias("winner")
    keys = [ref(k) if isinstance(k, str) else k for k in key]
    groups = [
        (F.collate(k, collation) if collation else k).alias(f"key{i}") for i, k in enumerate(keys)
    ]
    measures = [winner]
    if count_as:
        measures.append(F.count(F.lit(1)).alias("merged"))
    picked = df.groupBy(*groups).agg(*measures)
    columns = [F.col("winner").getField(c).alias(c) for c in df.columns]
    if count_as:
        columns.append(F.col("merged").alias(count_as))
    return picked.select(*columns)


def _repeated_keys_bitmap(keys: DataFrame, bits: int) -> DataFrame:
    """``page, bitmap``: a bit for the hash of every key that occurs more than once, in pages of ``PAGE_BITS``.

    Stored, so that what reads it does not count the keys again; at most ``bits / 8`` bytes.
    """
    repeated = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    bit = F.pmod(F.xxhash64(*[ref(k) for k in keys.columns]), F.lit(bits))
    placed = repeated.select(bit.alias("bit")).selectExpr(f"bit div {PAGE_BITS} AS page", f"bit % {PAGE_BITS} AS place")
    return store(placed.groupBy("page").agg(F.bitmap_construct_agg("place").alias("bitmap")), "repeated-keys")


def split_by_repetition(df: DataFrame, key: Sequence[str | Column], bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows whose key certainly occurs once, and all others.

    The keys are counted on their own columns. Those that repeat are marked in a bitmap of constant size, which every task
    gets; a row whose bit is clear cannot have a repeated key. Rows move nowhere. Where so many keys repeat that the
    bitmap fills, more single rows are among the others, which costs time but is never wrong.
    """
    keys = [ref(k) if isinstance(k, str) else k for k in key]
    names = [f"k{i}" for i in range(len(keys))]
    bitmap = _repeated_keys_bitmap(df.select(*[k.alias(n) for k, n in zip(keys, names)]), bits)
    page, held, place = (X.spare_name(df.columns, n) for n in ("key_page", "key_bitmap", "key_place"))
    bit = F.pmod(F.xxhash64(*keys), F.lit(bits))
    marked = df.withColumns({page: F.call_function("div", bit, F.lit(PAGE_BITS).cast("bigint")), place: (bit % PAGE_BITS).cast("int")})
    bitmap = bitmap.select(F.col("page").alias(page), F.col("bitmap").alias(held))
    marked = marked.join(F.broadcast(bitmap), page, "left")
    byte = F.conv(F.hex(F.substring(ref(held), F.shiftright(ref(place), 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), ref(place) % 8)) > 0, F.lit(False))
    columns = [ref(c) for c in df.columns]
    return marked.where(~is_set).select(*columns), marked.where(is_set).select(*columns)


def split_upsert(
    df: DataFrame, key: Sequence[str | Column], order_by: Sequence[str] = (), bits: int = BITMAP_BITS
) -> DataFrame:
    """The rows of :func:`latest_per_key`, of which only those with repeated keys are shuffled in full.

    One narrow shuffle counts the keys; rows whose key occurs once pass as they are read. The table is read once for
    its keys and twice for its rows, so this pays where few keys repeat or rows are wide.
    """
    single, repeated = split_by_repetition(df, key, bits)
    return single.unionByName(latest_per_key(repeated, key, order_by))


def merge_by_key(
    target: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``target`` after upserting ``changes``: replaced, added and kept rows.

    A change replaces the row with its key; a NULL in a key equals NULL, as it does among the changes. With
    ``order_by`` it replaces only where that row is not newer. The target is read once in full, plus once in its key and
    order columns, and is not shuffled while the keys of the changes are small
    enough for Spark to broadcast by its own size check.
    """
    columns = [ref(c) for c in target.columns]
    # A struct is never NULL, so it joins rows whose key holds NULLs like others.
    target_key = X.spare_name(target.columns, "merge_key")
    change_key = X.spare_name([*target.columns, target_key], "change_key")
    winners = latest_per_key(changes.select(*columns), key, order_by)
    whole_key = F.struct(F.lit(0).alias("all"), *[ref(k) for k in key])
    keyed, winners = target.withColumn(target_key, whole_key), winners.withColumn(change_key, whole_key)
    same = ref(target_key) == ref(change_key)
    if order_by:
        order = F.struct(*[ref(c) for c in order_by])
        present = keyed.select(ref(target_key), order.alias("present_order"))
        changed = winners.select(ref(change_key), order.alias("change_order"))
        stale = changed.join(present, same).where("present_order > change_order")
        stale = stale.select(ref(change_key).alias("stale_key"))
        winners = winners.join(stale, ref(change_key) == F.col("stale_key"), "left_anti")
    kept = keyed.join(winners.select(ref(change_key)), same, "left_anti").select(*columns)
    return kept.unionByName(winners.select(*columns))


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Loading without a key: everything is kept, repeats included."""
    return target.unionByName(rows)
