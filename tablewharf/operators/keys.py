"""Keys that nobody declared: the smallest sets of columns that tell all rows apart."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions.text import ref
from tablewharf.operators.ordering import store

# A sketch of 2**12 registers is off by 1.6 % (one standard deviation); a set is dropped that lacks far more than that.
SKETCH_BITS = 12
MISSING = 0.1
# Rows of a column's slice, about. A slice holds all rows of some of the column's values.
SLICE_ROWS = 1 << 15
_LEAD = "__lead"
KEY_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BooleanType,
             T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _sketched(names: Sequence[str]) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*[ref(n) for n in names]), SKETCH_BITS))


def _texts(df: DataFrame, names: Sequence[str], *more: Column) -> DataFrame:
    """Values as texts that differ for different values, named by their place; then more columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [F.hex(ref(n)) if isinstance(kinds[n], T.BinaryType) else _one_zero(df, n).cast("string") for n in names]
    return df.select(*[t.alias(f"t{i}") for i, t in enumerate(texts)], *more)


def _repeated(texts: DataFrame, names: Sequence[str], sets: Sequence[tuple[str, ...]], lead: Sequence[int] | None = None) -> dict[int, int]:
    """How many rows agree with another one, for the number of each set where any do, by one exact shuffle of all of them.

    With ``lead`` every set is looked at in the rows of its own ``lead`` only.
    """
    entries = [F.struct(F.lit(i).alias("set"), F.array(*[f"t{names.index(n)}" for n in s]).alias("key")) for i, s in enumerate(sets)]
    if lead is None:
        looked = F.array(*entries)
    else:
        looked = F.lit(None)
        for place in set(lead):
            own = F.array(*[e for e, at in zip(entries, lead) if at == place])
            looked = F.when(F.col(_LEAD) == place, own).otherwise(looked)
    keys = texts.select(F.inline(looked)).groupBy("set", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return {r["set"]: r["n"] for r in keys.groupBy("set").agg(F.sum("n").alias("n")).collect()}


def _sliced(df: DataFrame, names: Sequence[str], slices: int) -> DataFrame:
    """The texts of each column's slice, with the column's number: rows that agree on a column are in its slice all or none."""
    inside = [F.when(F.pmod(_hashed(df, [n]), F.lit(slices)) == 0, F.lit(i)) for i, n in enumerate(names)]
    rows = df.select(*[ref(n) for n in names], F.explode(F.array_compact(F.array(*inside))).alias(_LEAD))
    texts = _texts(rows, names, F.col(_LEAD))
    return store(texts.repartition(df.sparkSession.sparkContext.defaultParallelism), "key-slices")


def _hashed(df: DataFrame, names: Sequence[str]) -> Column:
    return F.xxhash64(*[_one_zero(df, n) for n in names])


def _proven(df: DataFrame, sets: Sequence[tuple[str, ...]], bases: Sequence[tuple[str, ...]]) -> set[int]:
    """The numbers of those sets of which no two rows agree.

    A set's base is a part of it, or all of it: rows that agree on the set agree on the base, and so does the base's hash. Whole
    tables are grouped by the hashes of the bases only; the sets are compared exactly on the rows whose hash repeats.
    """
    different = sorted(set(bases))
    entries = [F.struct(F.lit(i).alias("base"), _hashed(df, names).alias("hash")) for i, names in enumerate(different)]
    hashes = df.select(F.inline(F.array(*entries))).groupBy("base", "hash").agg(F.count(F.lit(1)).alias("n"))
    repeated = store(hashes.where("n > 1").select("base", "hash"), "key-hashes")
    open_bases = {r[0] for r in repeated.select("base").distinct().collect()}
    proven = {i for i, base in enumerate(bases) if different.index(base) not in open_bases}
    for place in open_bases:
        inside = [i for i, base in enumerate(bases) if base == different[place]]
        used = list(dict.fromkeys(n for i in inside for n in sets[i]))
        texts = _texts(df, used, _hashed(df, different[place]).alias("hash"))
        some = texts.join(repeated.where(F.col("base") == place), "hash", "left_semi")
        found = _repeated(some, used, [sets[i] for i in inside])
        proven |= {i for at, i in enumerate(inside) if at not in found}
    return proven


def _one_zero(df: DataFrame, name: str) -> Column:
    """A value whose zero has one sign."""
    floats = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return F.when(ref(name) == 0, F.lit(0.0)).otherwise(ref(name)) if floats else ref(name)


def minimal_keys(df: DataFrame, most_columns: int = 3) -> list[tuple[str, ...]]:
    """All keys of at most ``most_columns`` columns of which no part is a key already, in column order.

    A key has no NULL and no repeated value. One pass counts rows and NULLs and sketches the distinct values of every column. Then
    the search goes level by level. Sets whose columns have too few values between them are no keys. In a
    table of few rows each further level sketches its sets in one pass, and those whose sketch lacks no more than ``MISSING`` of
    the rows are proven exactly. In a larger one the sets are compared exactly in a slice of their column with the most
    values: two rows that agree there are proof that a set is no key. Those left are proven on all rows; a set of
    several columns only on the rows that its nearest part does not tell apart. Supersets of keys are not looked at. A table without
    rows has no keys.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, KEY_TYPES)]
    if not names:
        return []
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(ref(n).isNull()).alias(f"null{i}") for i, n in enumerate(names)],
        *[_sketched([n]).alias(f"values{i}") for i, n in enumerate(names)],
    ).first()
    rows = counted["rows"]
    values = {n: counted[f"values{i}"] for i, n in enumerate(names) if not counted[f"null{i}"]}
    names = [n for n in names if n in values]
    found: list[tuple[str, ...]] = []
    slices = max(1, rows // SLICE_ROWS)
    sliced, repeats = None, {}
    for level in range(1, most_columns + 1):
        sets = [s for s in combinations(names, level) if not any(set(k) <= set(s) for k in found)]
        sets = [s for s in sets if _most(values, s) >= rows * (1 - MISSING)]
        if not sets or not rows:
            continue
        if slices == 1:
            likely = sets
            if level > 1:
                estimates = df.agg(*[_sketched(s).alias(f"s{i}") for i, s in enumerate(sets)]).first()
                likely = [s for s, n in zip(sets, estimates) if n >= rows * (1 - MISSING)]
            repeated = _repeated(_texts(df, names), names, likely) if likely else {}
            found += [s for i, s in enumerate(likely) if i not in repeated]
            continue
        if sliced is None:
            sliced = _sliced(df, names, slices)
        repeated = _repeated(sliced, names, sets, [names.index(max(s, key=values.get)) for s in sets])
        repeats |= {frozenset(s): repeated.get(i, 0) for i, s in enumerate(sets)}
        likely = [s for i, s in enumerate(sets) if i not in repeated]
        if likely:
            proven = _proven(df, likely, [_base(s, repeats, rows // slices) for s in likely])
            found += [s for i, s in enumerate(likely) if i in proven]
    return found


def _base(names: tuple[str, ...], repeats: dict[frozenset, int], slice_rows: int) -> tuple[str, ...]:
    """The part with one column less that tells most rows apart, if it leaves few rows; else all columns."""
    parts = [p for p in combinations(names, len(names) - 1) if frozenset(p) in repeats]
    best = min(parts, key=lambda p: repeats[frozenset(p)], default=names)
    return best if repeats.get(frozenset(best), 0) <= slice_rows * MISSING else names


def _most(values: dict[str, int], names: Sequence[str]) -> float:
    """How many different rows these columns can have at most, by their sketches."""
    most = 1.0
    for n in names:
        most *= values[n] * (1 + MISSING)
    return most
