"""Mix sources to target weights by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewharf.llm.common import WORD, store, with_prefix

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
NEWTON_STEPS = 60


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MOST_COPIES, row_id: str | None = None) -> DataFrame:
    """How often each document enters a mix in which sources have target sizes.

    Size is the number of words. Sources in code point order, null last, weigh
    ``weights`` in turn and share the size of the whole table; a target stops at ``cap`` times
    its source and the excess is shared again by weight until none is above.

    Entropy balancing finds, among all rates that give every source its target, those
    closest to 1 in relative entropy under the bound ``cap``: a document of x words gets
    ``min(cap, exp(lambda * x))``, one multiplier for each source. Newton steps on the convex
    dual, kept in brackets, find all multipliers at once; each step is one aggregate over
    the table of (source, size) counts. Rates become whole copies by rounding running
    totals, largest documents first; what rounding left in words is then spread over documents that can hold it,
    until it is less than the smallest that can still change.

    Returns ``doc_id, source, size, source_size, target, copies, taken`` for every row
    (``taken = copies * size``). Documents without words keep one copy and take nothing; null texts
    have no words; a null source is a source; repeated rows count each; an empty table gives no
    rows; other columns are ignored, except that of the name ``row_id``, which is returned first. Equal input gives equal results.
    """
    named = ["doc_id"] if row_id is None else [row_id, "doc_id"]
    sized = store(docs.select(*named, F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size")), "mix-sizes")
    sources = store(_targets(sized, weights, cap), "mix-sources")
    same = sized["source"].eqNullSafe(sources["source"])
    rows = sized.join(sources.select("source", "sid", "source_size", "target"), same).drop(sources["source"])
    cells = store(rows.where("size > 0").groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    copies = _copies(cells, _multipliers(cells, sources, cap), sources, cap)

    order = ["sid", "size", F.xxhash64("doc_id"), *reversed(named)]
    ranked = with_prefix(rows, order, [], "mix-ranks")
    first = ranked.groupBy("sid", "size").agg(F.min("row_index").alias("first_index"))
    plan = first.join(copies, ["sid", "size"], "left")
    extra = (F.col("row_index") - F.col("first_index") < F.col("copies") % F.col("n")).cast("long")
    each = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.expr("copies div n") + extra).cast("long")
    return ranked.join(plan, ["sid", "size"]).select(
        *named, "source", "size", "source_size", "target", each.alias("copies"), (each * F.col("size")).alias("taken")
    )


def _targets(sized: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """One row per source: number ``sid``, ``source_size`` and ``target``."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), "source"]
    ranked = with_prefix(totals, order, ["source_size"], "mix-order").withColumnRenamed("row_index", "sid")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = store(ranked.select("source", "sid", "source_size", weight.alias("weight")), "mix-weights")
    limit = F.col("source_size") * float(cap)
    level, full = 0.0, -1
    while True:
        above = limit <= F.col("weight") * level
        total, held, open_weight, count = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(above, limit).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if not total or not open_weight or count == full:
            break
        level, full = (total - held) / open_weight, count
    target = F.least(limit, F.col("weight") * F.lit(level)) if level else F.lit(0.0)
    return sources.select("source", "sid", "source_size", target.cast("double").alias("target"))


def _multipliers(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """The dual solution: ``(sid, lam)`` for sources with words."""
    x, n = F.col("size").cast("double"), F.col("n")
    ratio = F.col("target") / F.col("source_size")
    weighted = F.col("squares") / F.col("source_size")
    bare = cells.groupBy("sid").agg(F.sum(n * x * x).alias("squares"))
    state = sources.where("source_size > 0").join(bare, "sid").select(
        "sid",
        "target",
        F.when(ratio < 1, F.log(ratio)).otherwise(0.0).alias("lo"),
        F.when(ratio < 1, 0.0).otherwise(F.lit(math.log(cap))).alias("hi"),
        F.when(ratio >= cap, F.lit(math.log(cap))).otherwise(F.log(ratio) / weighted).alias("lam"),
        F.lit(False).alias("done"),
    )
    state = store(state, "mix-newton")
    for _ in range(NEWTON_STEPS):
        tilt = F.exp(F.col("lam") * x)
        slopes = cells.join(state.select("sid", "lam"), "sid").groupBy("sid").agg(
            F.sum(n * x * F.least(tilt, F.lit(float(cap)))).alias("got"),
            F.sum(F.when(tilt < cap, n * x * x * tilt).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        near = F.abs(gap) <= F.lit(1e-6) * F.col("target")
        moved = state.join(slopes, "sid").select(
            "sid",
            "target",
            F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")).alias("lo"),
            F.when(gap > 0, F.col("lam")).otherwise(F.col("hi")).alias("hi"),
            "lam",
            (F.col("lam") - F.try_divide(gap, F.col("slope"))).alias("step"),
            near.alias("done"),
        )
        inside = (F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi")) & ~F.isnan("step")
        lam = F.when(F.col("done"), F.col("lam")).when(F.coalesce(inside, F.lit(False)), F.col("step")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = store(moved.select("sid", "target", "lo", "hi", lam.alias("lam"), "done"), "mix-newton")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("sid", "lam")


def _copies(cells: DataFrame, multipliers: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Whole copies for each cell of documents with the same source and size."""
    rate = F.least(F.exp(F.col("lam") * F.col("size")), F.lit(float(cap)))
    due = cells.join(multipliers, "sid").withColumn("due", F.col("n") * rate)
    upto = Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("due").over(upto)
    last = F.floor(total - F.col("due") + 0.5)
    whole = F.greatest(F.lit(0), F.least(F.floor(total + 0.5) - last, cap * F.col("n"))).cast("long")
    return _mended(store(due.select("sid", "size", "n", whole.alias("copies")), "mix-copies"), sources, cap)


def _mended(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Copies added or taken away until what a source lacks is less than its smallest document that can still change.

    Two turns in three spread the rest evenly over all documents that it can hold; the third fills
    the largest of them first, which halves the rest at least, so the turns end. At last single
    copies are exchanged for some of other sizes while that halves what a source still misses.
    """
    source = Window.partitionBy("sid")
    order = source.orderBy(F.desc("size"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = 0
    while True:
        size, rest, room = F.col("size"), F.abs("rest"), F.col("room")
        usable = _open(cells, sources, cap).where(size <= rest)
        if turn % 3 < 2:
            part = F.least(F.lit(1.0), rest / F.sum(room * size).over(source))
            whole = usable.withColumn("part", part).withColumn("whole", F.floor(F.sum(room * F.col("part")).over(upto) + 1e-9))
            more = F.least(room, F.col("whole") - F.coalesce(F.lag("whole").over(order), F.lit(0)))
        else:
            whole = usable.withColumn("before", F.sum(room * size).over(upto) - room * size)
            more = F.greatest(F.lit(0), F.least(room, F.floor((rest - F.col("before")) / size)))
        moves = whole.select("sid", "size", (more * F.signum("rest")).cast("long").alias("change"))
        moves = store(moves.where("change <> 0"), "mix-moves")
        if moves.isEmpty():
            break
        cells = _changed(cells, moves)
        turn += 1
    while True:
        moves = store(_exchanges(cells, sources, cap), "mix-moves")
        if moves.isEmpty():
            return cells
        cells = _changed(cells, moves)


def _open(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Cells with the words that their source lacks (``rest``) and the copies (``room``) that they can still change by."""
    got = cells.groupBy("sid").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    rest = sources.join(got, "sid").select("sid", (F.col("target") - F.col("got")).alias("rest"))
    room = F.when(F.col("rest") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    return cells.join(rest, "sid").select("sid", "size", "rest", room.alias("room")).where("room > 0 and rest <> 0")


def _exchanges(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """For each source the copy to add, to take away, or to take away for another, that leaves least, if that is half of its rest at most.

    A removed size and the rest name the size to add; sorted together, the nearest sizes stand beside it.
    """
    got = cells.groupBy("sid").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    rest = sources.join(got, "sid").select("sid", (F.col("target") - F.col("got")).alias("rest"))
    size, none = F.col("size"), F.lit(None).cast("long")
    nothing = rest.select("sid", F.lit(0).cast("long").alias("size"), F.lit(True).alias("less"), F.lit(True).alias("more"))
    cells = cells.select("sid", "size", (F.col("copies") > 0).alias("less"), (F.col("copies") < cap * F.col("n")).alias("more"))
    both = cells.union(nothing).join(rest, "sid")
    added = both.where("more").select("sid", size.cast("double").alias("at"), none.alias("gone"), "size", "rest")
    asked = both.where("less").select("sid", (size + F.col("rest")).alias("at"), size.alias("gone"), none.alias("size"), "rest")
    order = Window.partitionBy("sid").orderBy("at")
    below = F.last("size", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first("size", ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    beside = added.union(asked).withColumn("pair", F.array(below, above)).where("gone is not null")
    beside = beside.select("*", F.explode("pair").alias("new")).where("new is not null")
    left = F.abs(F.col("at") - F.col("new"))
    best = beside.where(left <= F.abs("rest") / 2).groupBy("sid").agg(F.min(F.struct(left.alias("left"), "gone", "new")).alias("best"))
    change = F.array(
        F.struct(F.col("best.gone").alias("size"), F.lit(-1).cast("long").alias("change")),
        F.struct(F.col("best.new").alias("size"), F.lit(1).cast("long").alias("change")),
    )
    return best.where("best.gone <> best.new").select("sid", F.explode(change).alias("c")).select("sid", "c.*").where("size > 0")


def _changed(cells: DataFrame, moves: DataFrame) -> DataFrame:
    copies = F.col("copies") + F.coalesce("change", F.lit(0))
    return store(cells.join(moves, ["sid", "size"], "left").select("sid", "size", "n", copies.alias("copies")), "mix-copies")
