"""Greedy batches under a byte limit, cut in parallel.

Whether a row opens a batch depends on all rows before it. But inside a range of rows the answer depends only
on where the first batch of the range opens, and few places are possible: those within one batch's length of the range's
start. So every range works out for each of them where its last batch opens and how many there are (by pointer
doubling), the ranges' answers are followed in order, one short row list for each range, and then every
range numbers its rows by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewharf.functions import text as X
from tablewharf.functions.text import ref
from tablewharf.operators.ordering import store, with_prefix

RANGE_ROWS = 1 << 18


def byte_size(columns: Sequence[str]) -> Column:
    """UTF-8 bytes of the texts of a row; NULL counts as none."""
    return sum((F.coalesce(F.octet_length(ref(c)), F.lit(0)).cast("bigint") for c in columns), F.lit(0).cast("bigint"))


def with_bounded_batches(
    df: DataFrame,
    size: Column,
    order_by: str | Sequence[str],
    max_bytes: int,
    group: Sequence[str] = (),
    range_rows: int = RANGE_ROWS,
    name: str = "batch_id",
) -> DataFrame:
    """Number batches of rows in order, each as long as it stays within ``max_bytes``.

    A row opens a new batch if with it the open one would exceed the limit, so no batch is above the limit unless it
    consists of one row. ``size`` is whole and not negative; NULL counts as 0. A batch holds rows of
    one ``group``; numbers count from 0 over all groups. Rows that tie in ``order_by`` take any order among themselves.

    The rows are put in order once; then only their places and sizes move. A task holds ``range_rows`` places.
    """
    keys = [*group, *([order_by] if isinstance(order_by, str) else order_by)]
    taken = [*df.columns, name]
    measure, record = X.spare_name(taken, "size"), X.spare_name(taken, "record")
    whole = F.struct(*[ref(c) for c in df.columns]).alias(record)
    named = {X.spare_name(taken, f"order{i}"): ref(k) for i, k in enumerate(keys)}
    rows = df.select(whole, F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")).alias(measure), *[k.alias(n) for n, k in named.items()])
    numbered = with_prefix(rows, [ref(n) for n in named], [measure], "batch-rows")
    places = numbered.select("row_index", ref(measure).alias("size"), ref(f"before_{measure}").alias("before"), *[ref(n) for n in named])
    opens = F.lit(False)
    if group:
        whole_group = F.struct(*[ref(n) for n in list(named)[: len(group)]])
        places = store(places.withColumn("group_key", whole_group), "batch-places")
        firsts = places.groupBy("group_key").agg(F.min("row_index").alias("row_index")).select("row_index", F.lit(True).alias("opens"))
        places, opens = places.join(firsts, "row_index", "left"), F.coalesce("opens", F.lit(False))
    part = F.call_function("div", F.col("row_index"), F.lit(range_rows)).alias("part")
    places = store(places.select(part, "row_index", "size", "before", opens.alias("opens")), "batch-ranges")
    entries = _followed(_summaries(places, max_bytes), max_bytes)
    batches = _assigned(places.join(entries, "part"), max_bytes).withColumnRenamed("batch", name)
    joined = numbered.join(batches, "row_index")
    return joined.select(*[F.col(record).getField(c).alias(c) for c in df.columns], ref(name))


def _summaries(places: DataFrame, limit: int) -> DataFrame:
    """For each range, in order: entered below ``upto`` it opens ``batches``, the last one at ``last`` (NULL: none)."""

    def summary(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_index")
        before, size = table.column("before").to_numpy(), table.column("size").to_numpy()
        ends, n = before + size, len(before)
        forced = np.flatnonzero(table.column("opens").to_numpy())
        after = np.append(forced, n)[np.searchsorted(forced, np.arange(n), side="right")]
        jump = np.maximum(np.searchsorted(ends, before + limit, side="right"), np.arange(n) + 1)
        jump = np.minimum(jump, after)
        last, count = np.where(jump < n, jump, np.arange(n)), (jump < n).astype(np.int64)
        while True:  # pointer doubling: after k rounds each pointer has made up to 2**k steps
            further = last[last]
            if (further == last).all():
                break
            count, last = count + count[last], further
        reach = int(np.searchsorted(ends, before[0] + limit, side="right"))
        first_forced = int(forced[0]) if len(forced) else n
        entry = np.arange(min(reach, first_forced, n - 1) + 1)
        upto, opened, exits = ends[entry].copy(), count[entry] + 1, before[last[entry]].astype(object)
        if entry[-1] == first_forced:
            upto[-1] = np.iinfo(np.int64).max
        elif reach == n:  # the whole range may lie inside one batch
            upto = np.append(upto, np.iinfo(np.int64).max)
            opened, exits = np.append(opened, 0), np.append(exits, None)
        different = (opened[1:] != opened[:-1]) | np.array([a != b for a, b in zip(exits[1:], exits[:-1])], dtype=bool)
        keep = np.append(np.flatnonzero(different), len(upto) - 1)
        parts = np.full(len(keep), table.column("part")[0].as_py())
        columns = [pa.array(parts), pa.array(upto[keep]), pa.array(opened[keep]), pa.array(exits[keep].tolist(), pa.int64())]
        return pa.table(columns, names=["part", "upto", "batches", "last"])

    return places.groupBy("part").applyInArrow(summary, "part long, upto long, batches long, last long")


def _followed(summaries: DataFrame, limit: int) -> DataFrame:
    """``part, opened_at, before_it``: where the batch opened that goes into each range, and the batches before."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened_at, count, now = -limit - 1, 0, None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for part, upto, opened, last in zip(*(c.to_pylist() for c in batch.columns)):
                if part == now or opened_at + limit >= upto:
                    continue
                now = part
                out.append((part, opened_at, count))
                count += opened
                opened_at = opened_at if last is None else last
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "opened_at", "before_it"])

    in_order = summaries.repartition(1).sortWithinPartitions("part", "upto")
    return store(in_order.mapInArrow(follow, "part long, opened_at long, before_it long"), "batch-entries")


def _assigned(places: DataFrame, limit: int) -> DataFrame:
    def assign(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_index")
        before, size = table.column("before").to_numpy(), table.column("size").to_numpy()
        ends, n = before + size, len(before)
        forced = np.append(np.flatnonzero(table.column("opens").to_numpy()), n)
        starts = np.zeros(n, dtype=np.int64)
        at = int(np.searchsorted(ends, table.column("opened_at")[0].as_py() + limit, side="right"))
        at = min(at, int(forced[0]))
        while at < n:
            starts[at] = 1
            full = max(at + 1, int(np.searchsorted(ends, before[at] + limit, side="right")))
            at = min(full, int(forced[np.searchsorted(forced, at, side="right")]))
        batch = table.column("before_it")[0].as_py() - 1 + np.cumsum(starts)
        return pa.table({"row_index": table.column("row_index"), "batch": pa.array(batch)})

    return places.groupBy("part").applyInArrow(assign, "row_index long, batch long")
