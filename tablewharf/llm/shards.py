"""Shards of vectors that stay in place while others come by in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def meet(
    stored: DataFrame,
    visitors: DataFrame,
    shards: int,
    hold: Callable[[pa.Table, int], Any],
    ask: Callable[[Any, pa.RecordBatch, int], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``ask`` yields for the visitors of each shard.

    Both sides have ``dim`` and ``shard``; what only one has is null on the other. A shard's stored rows are dealt to one task once and come
    first in it: ``hold`` turns them, of one length ``dim``, into what is asked; then its visitors stream by, batch after batch. So a stored
    row moves once, a visitor once for each shard it visits, and a task holds one shard and one batch.
    """
    both = stored.withColumn("turn", F.lit(0)).unionByName(visitors.withColumn("turn", F.lit(1)), allowMissingColumns=True)
    ordered = both.repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "turn")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, held = None, [], None
        for batch in batches:
            for group, turn, part in runs(batch):
                if group != now:
                    now, waiting, held = group, [], None
                if turn == 0:
                    waiting.append(part)
                elif waiting:
                    held = hold(pa.Table.from_batches(waiting), now[0]) if held is None else held
                    yield from ask(held, part, now[0])

    return ordered.mapInArrow(meeting, schema)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """Parts of a batch with the same dimension, shard and turn."""
    if not batch.num_rows:
        return
    dims, shards, turns = (batch.column(c).to_numpy() for c in ("dim", "shard", "turn"))
    change = (np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(turns) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield (int(dims[a]), int(shards[a])), int(turns[a]), batch.slice(a, b - a)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int = -1) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim) for part in parts])


def table_of(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    """Rows, given as tuples, as a batch."""
    values = list(zip(*columns)) if columns else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)
