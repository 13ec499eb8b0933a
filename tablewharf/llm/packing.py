"""Pack documents into sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewharf.llm.common import store, with_prefix

LENGTH = 2048
# Lengths are planned in steps of this many tokens; a pattern wastes less than one step per piece.
STEP = 16
END = 1
# The linear program is solved to this relative gap, or in this many rounds.
GAP = 0.002
ROUNDS = 2000


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Token ids of whole texts, each closed by ``end``, cut into full sequences and one rest.

    ``doc_id, row, start, length, ids_crc32, doc_tokens`` for each piece; ``row`` tells
    repeated rows apart.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tablewharf.llm.pretokens import pre_tokens

        encoder = pre_tokens(tokenizer)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            parts: list[list[np.ndarray]] = [[] for _ in texts]
            for index, _, ids in encoder.encode(texts, want_ids=True):
                parts[index].append(ids)
            which, starts, sizes, checks, totals = [], [], [], [], []
            closing = np.array([end], dtype="<u4")
            for index, ids in enumerate(parts):
                data = np.concatenate([*ids, closing]).astype("<u4", copy=False)
                for start in range(0, len(data), length):
                    piece = data[start : start + length]
                    which.append(index)
                    starts.append(start)
                    sizes.append(len(piece))
                    checks.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(data))
            taken = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken)]
                + [pa.array(x, pa.int64()) for x in (starts, sizes, checks, totals)],
                names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Every document's tokens in sequences of at most ``length`` tokens.

    Full pieces are sequences of their own. The rests are a cutting-stock problem on
    their histogram, at most ``length / STEP`` classes whatever the input: a linear
    program over patterns, priced by knapsack dynamic programming, is solved on the driver; its
    solution is rounded down and the remainder packed first-fit by the same classes. Every class's pieces
    are ranked, and a piece's rank says which pattern and which sequence it joins, without
    moving text.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for each piece.
    A null or empty text is one piece with the closing id alone; a long text fills many sequences;
    repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    cut = store(pieces(docs, tokenizer, length, end), "pack-pieces")
    steps = F.ceil(F.col("length") / STEP).cast("int")
    rests = cut.where(F.col("length") < length).withColumn("steps", steps)
    counts = {r["steps"]: r["n"] for r in rests.groupBy("steps").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_patterns(counts, -(-length // STEP))
    spark = docs.sparkSession

    first_sequence = 0
    given = dict.fromkeys(counts, 0)
    by_class: dict[int, list[tuple[int, int, int]]] = {}
    for pattern, times in plan:
        for size, each in pattern:
            by_class.setdefault(size, []).append((given[size], each, first_sequence))
            given[size] += each * times
        first_sequence += times
    slots_table = spark.createDataFrame(
        sorted(by_class.items()), "steps int, slots array<struct<first_rank:long,each:long,first_sequence:long>>"
    )
    ranked = with_prefix(rests, ["steps", F.xxhash64("doc_id", "start"), "doc_id", "row"], [], "pack-ranks")
    first = ranked.groupBy("steps").agg(F.min("row_index").alias("first_index"))
    # At most one row per class: bounded whatever the input.
    placed = ranked.join(F.broadcast(first.join(slots_table, "steps")), "steps")
    placed = placed.withColumn("rank", F.col("row_index") - F.col("first_index"))
    slot = F.expr("element_at(filter(slots, s -> s.first_rank <= rank), -1)")
    placed = placed.withColumn("slot", slot).withColumn(
        "sequence_id", F.expr("slot.first_sequence + (rank - slot.first_rank) div slot.each")
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row_index")
    upto = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rests_placed = placed.withColumn("offset", upto - F.col("length")).select(*columns)

    full = with_prefix(cut.where(F.col("length") == length), ["doc_id", "start", "row"], [], "pack-full")
    full = full.withColumns({"sequence_id": F.col("row_index") + F.lit(first_sequence), "offset": F.lit(0).cast("long")})
    return rests_placed.unionByName(full.select(*columns))


Pattern = tuple[tuple[int, int], ...]


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of sizes that fill ``capacity``, each with how often it is used; they
    cover ``counts`` exactly. The work depends on the number of sizes only."""
    sizes = np.array(sorted(s for s, n in counts.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([counts[s] for s in sizes.tolist()], dtype=np.int64)
    patterns, amounts = _relaxed(sizes, left.astype(float), capacity)
    plan: list[tuple[np.ndarray, int]] = []
    for pattern, amount in sorted(zip(patterns, amounts), key=lambda x: -x[1]):
        used = pattern > 0
        times = int(min(np.floor(amount + 1e-6), (left[used] // pattern[used]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= pattern * times
    while left.any():  # what rounding left: fill one sequence after the other, largest first
        pattern, room = np.zeros_like(left), capacity
        for k in np.argsort(-sizes):
            each = min(int(left[k]), room // int(sizes[k]))
            pattern[k], room = each, room - each * int(sizes[k])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((pattern, times))
        left -= pattern * times
    return [(tuple((int(sizes[k]), int(p[k])) for k in np.flatnonzero(p)), t) for p, t in plan]


def _relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The linear program by column generation: revised simplex from single-size patterns."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    amounts, bound = _times(inverse, demand), 0.0
    for step in range(ROUNDS):
        prices = np.maximum(inverse.sum(axis=0), 0)  # each pattern costs one sequence
        pattern, value = _knapsack(sizes, prices, capacity)
        total = amounts.sum()
        bound = max(bound, total / value)  # Farley's lower bound
        if total <= bound * (1 + GAP):
            break
        direction = _times(inverse, pattern)
        moves = direction > 1e-9
        ratios = np.full(m, np.inf)
        ratios[moves] = np.maximum(amounts[moves], 0) / direction[moves]
        out = int(np.argmin(ratios))
        basis[:, out] = pattern
        if step % 100 == 99:
            inverse = _inverse(basis)
        else:
            row = inverse[out] / direction[out]
            inverse = inverse - np.outer(direction, row)
            inverse[out] = row
        amounts = _times(inverse, demand)
    return [np.rint(basis[:, k]).astype(np.int64) for k in range(m)], np.maximum(amounts, 0)


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    # Not by BLAS: its threads may not survive the fork that starts Spark's JVM.
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with row pivots, without BLAS as above."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        pivot = k + int(np.argmax(np.abs(both[k:, k])))
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0
        both -= np.outer(factors, both[k])
    return both[:, n:]


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The pattern of greatest total price that fits."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, dtype=np.int64)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if fits:
            values = best[room - sizes[:fits]] + prices[:fits]
            k = int(np.argmax(values))
            if values[k] > best[room] + 1e-12:
                best[room], choice[room] = values[k], k
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        pattern[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return pattern, float(best[capacity])
