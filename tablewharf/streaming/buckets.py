"""A base of a keyed table in buckets, of which a compaction rewrites only those that changed.

Rows go to buckets by a hash of their key. A manifest names, for every bucket, the folder that holds its rows, and
the last batch that is folded in. Compacting writes the touched buckets into new folders and then commits the next
manifest as a single file, so a crash before that leaves the table as it was, and no folder is ever changed after
it was written. Whoever reads needs only the folder: the state is stored with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.functions import text as X
from tablewharf.functions.text import ref
from tablewharf.operators.ordering import store
from tablewharf.operators.upsert import latest_per_key, merge_by_key
from tablewharf.streaming.incremental import changes

MANIFEST_SCHEMA = "version long, commit string, last_batch long, buckets int, bucket int, folder string, rows long"
# The manifest's row that stands for the whole table: it has the last batch even where no bucket has rows.
WHOLE = -1


@dataclass(frozen=True)
class State:
    """One version of the base: folders by bucket, and the last batch in it."""

    version: int = 0
    last_batch: int = -1
    folders: dict[int, str] | None = None
    rows: dict[int, int] | None = None


@dataclass(frozen=True)
class BucketedTable:
    """The table kept by :func:`upsert_stream` under ``folder``, with a bucketed base.

    ``buckets`` is fixed with the first compaction; later ones must state the same number. ``files`` deals the
    rows of a bucket to that many tasks and files. One compaction runs at a time: two that commit the same
    version are noticed by the next reader, which raises.
    """

    spark: SparkSession
    folder: str
    key: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    buckets: int = 64
    files: int = 1

    def manifest(self) -> DataFrame:
        """All versions; rows with bucket -1 stand for the table."""
        reader = self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.folder}/manifest")

    def state(self, version: int | None = None) -> State:
        """The newest version, or an older one; at most one row for each bucket comes to the driver."""
        try:
            rows = self.manifest()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return State()
        newest = version if version is not None else rows.agg(F.max("version")).first()[0]
        found = rows.where(F.col("version") == newest).collect() if newest is not None else []
        if not found:
            return State()
        if len({r["commit"] for r in found}) > 1:
            raise RuntimeError(f"{self.folder}: two compactions committed version {newest}")
        if found[0]["buckets"] != self.buckets:
            raise ValueError(f"{self.folder} has {found[0]['buckets']} buckets, not {self.buckets}")
        held = [r for r in found if r["bucket"] != WHOLE]
        folders, rows = {r["bucket"]: r["folder"] for r in held}, {r["bucket"]: r["rows"] for r in held}
        return State(newest, found[0]["last_batch"], folders, rows)

    def bucket(self) -> Column:
        """The bucket of a row, from its key alone."""
        return F.pmod(F.xxhash64(*[ref(k) for k in self.key]), F.lit(self.buckets)).cast("int")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{f}" for f in folders])

    def _pending(self, state: State) -> tuple[DataFrame, int] | None:
        """Winners of the batches after the base, stored, and the last of these batches."""
        try:
            delta = changes(self.spark, self.folder, state.last_batch)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        last = delta.agg(F.max("batch")).first()[0]
        if last is None:
            return None
        delta = delta.where(F.col("batch") <= last)
        winners = latest_per_key(delta, self.key, [*self.order_by, "batch"]).drop("batch")
        return store(winners, "bucket-changes"), int(last)

    def _merged(self, state: State, winners: DataFrame) -> tuple[DataFrame | None, list[int]]:
        """The rows of all touched buckets after the change, and which these are."""
        touched = sorted(r[0] for r in winners.select(self.bucket()).distinct().collect())
        old = [state.folders[b] for b in touched if b in (state.folders or {})]
        if not old:
            return winners, touched
        return merge_by_key(self._read(old), winners, self.key, self.order_by), touched

    def current(self, version: int | None = None) -> DataFrame | None:
        """The table: untouched buckets as they are, touched ones merged with later batches; None before the first row.

        With ``version`` it is the base of an older compaction, without later batches.
        """
        state = self.state(version)
        folders = state.folders or {}
        pending = self._pending(state) if version is None else None
        if pending is None:
            return self._read(list(folders.values())) if folders else None
        merged, touched = self._merged(state, pending[0])
        rest = [folder for b, folder in folders.items() if b not in set(touched)]
        return self._read(rest).unionByName(merged) if rest else merged

    def compact(self) -> State:
        """Fold later batches into the buckets they touch; returns the new state, or the old one if nothing came."""
        state = self.state()
        pending = self._pending(state)
        if pending is None:
            return state
        merged, touched = self._merged(state, pending[0])
        name = X.spare_name(merged.columns, "bucket")
        target = f"base/{state.version + 1:010d}-{uuid.uuid4().hex}"
        dealt = merged.withColumn(name, self.bucket())
        place = F.pmod(F.hash(*[ref(k) for k in self.key]), F.lit(self.files))
        dealt = dealt.repartition(len(touched) * self.files, ref(name), place)
        dealt.write.partitionBy(name).option("compression", "zstd").parquet(f"{self.folder}/{target}")
        counts = self.spark.read.parquet(f"{self.folder}/{target}").groupBy(ref(name)).agg(F.count(F.lit(1)))
        new = {b: (f"{target}/{name}={b}", n) for b, n in counts.collect()}
        kept = {b: (f, (state.rows or {})[b]) for b, f in (state.folders or {}).items() if b not in new}
        return self._commit(state.version + 1, pending[1], {**kept, **new})

    def _commit(self, version: int, last_batch: int, held: dict[int, tuple[str, int]]) -> State:
        """One file holds the whole version, so it is there or it is not."""
        commit = uuid.uuid4().hex
        rows = [(version, commit, last_batch, self.buckets, b, f, n) for b, (f, n) in sorted(held.items())]
        rows.append((version, commit, last_batch, self.buckets, WHOLE, None, sum(n for _, n in held.values())))
        frame = self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
        frame.write.parquet(f"{self.folder}/manifest/{version:010d}-{commit}")
        return self.state()
