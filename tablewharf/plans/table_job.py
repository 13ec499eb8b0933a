"""Copy one table: read, clean, set bad rows aside, load as text."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewharf.functions import text as X
from tablewharf.functions.text import ref
from tablewharf.operators import clean, infer, quality
from tablewharf.operators.upsert import latest_per_key
from tablewharf.sinks.snapshots import write_version


@dataclass(frozen=True)
class TableJob:
    """One table to copy.

    ``key`` decides between upsert and append. ``key_is_unique`` states what is
    known about the cleaned key: ``True`` when the source guarantees it,
    ``None`` to have it checked on the data. ``order_by`` says which of several
    rows with the same key is the later one. An upsert removes exact copies by
    itself; ``count_duplicates`` pays one more shuffle to report them apart
    from older rows with the same key. ``spread`` deals the rows to that many
    tasks before the cleaning, for a source in few splits; without it no row moves.

    ``infer_types`` replaces the numeric repairs by type recovery: text columns
    named like dates become timestamps, wholly numeric text becomes numbers; key
    columns stay as they are. ``collation`` (such as ``UNICODE_CI``) compares text keys as a case-insensitive
    destination would. ``numeric_columns`` states the latter, as types by column or as
    names of double columns, instead of proving it on the data.

    ``prepare`` completes the job when it runs, for example by landing its source, so
    that a failure counts as a failed attempt of this table alone.
    """

    name: str
    source: DataFrame | None
    key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    key_is_unique: bool | None = None
    count_duplicates: bool = False
    fill_numeric: float | None = 0
    spread: int | None = None
    infer_types: bool = False
    numeric_columns: Mapping[str, str] | tuple[str, ...] | None = None
    limits: dict[str, int] = field(default_factory=dict)
    prepare: Callable[[TableJob], TableJob] | None = None
    collation: str | None = None


@dataclass(frozen=True)
class TableResult:
    """What happened to the rows of one table.

    ``src_rows = dst_rows + duplicates + superseded + quarantined``, counted apart
    from each other; only where exact copies are removed, ``duplicates`` is what is left. A copy whose
    counts do not add up fails. ``nulls``
    lists the columns of the loaded rows that hold NULLs after cleaning, with
    their number.
    """

    src_rows: int
    dst_rows: int = 0
    duplicates: int = 0
    superseded: int = 0
    quarantined: int = 0
    location: str | None = None
    quarantine: str | None = None
    nulls: dict[str, int] = field(default_factory=dict)


def _needs_distinct(job: TableJob, unique: bool) -> bool:
    return not unique and (not job.key or job.count_duplicates)


def _cleaned(job: TableJob, df: DataFrame) -> DataFrame:
    if job.infer_types:
        texts = clean.trim_strings(infer.coerce_datetimes(df, skip=job.key))
        numeric = job.numeric_columns or {}
        if not isinstance(numeric, Mapping):
            numeric = dict.fromkeys(numeric, "double")
        numeric = {c: t for c, t in numeric.items() if c in df.columns and c not in job.key}
        return clean.comparable_values(clean.null_non_finite(infer.infer_numbers(texts, numeric)))
    return clean.comparable_values(clean.clean_values(df, job.fill_numeric, job.key))


def _with_types(job: TableJob) -> TableJob:
    """The job with its numeric text columns found, by one pass over the source."""
    if not job.infer_types or job.numeric_columns is not None:
        return job
    texts = clean.trim_strings(infer.coerce_datetimes(job.source, skip=job.key))
    return replace(job, numeric_columns=infer.number_types(texts, skip=job.key))


def _reason_name(job: TableJob) -> str:
    return X.spare_name(job.source.columns, "refusal_reason")


def _marked_rows(job: TableJob, unique: bool) -> DataFrame:
    """Cleaned rows, still typed, with the reason why the target refuses them."""
    rows = job.source
    if job.spread:
        # By key only where no key can be hot; otherwise row by row.
        rows = rows.repartition(job.spread, *[ref(k) for k in job.key if unique])
    if _needs_distinct(job, unique):
        rows = clean.distinct_rows(rows)
    return quality.with_refusal_reason(
        _cleaned(job, rows), job.key, name=_reason_name(job), **job.limits
    )


def _refused_rows(job: TableJob, unique: bool) -> DataFrame:
    """The source values of refused rows as text, as they came: neither trimmed nor filled; with the reason."""
    rows = clean.distinct_rows(job.source) if _needs_distinct(job, unique) else job.source
    reason, held = _reason_name(job), X.spare_name([*rows.columns, _reason_name(job)], "source_row")
    texts = [
        (ref(f.name) if f.dataType.typeName() == "string" else X.canonical_text(f.name, f.dataType)).cast("string").alias(f.name)
        for f in rows.schema.fields
    ]
    whole = rows.select(*[ref(c) for c in rows.columns], F.struct(*texts).alias(held))
    cleaned = _cleaned(job, whole)
    why = quality.refusal_reason(cleaned.drop(held).schema, job.key, **job.limits)
    marked = cleaned.withColumn(reason, why).where(ref(reason).isNotNull())
    return marked.select(*[ref(held).getField(c).alias(c) for c in rows.columns], ref(reason))


def _destination_key(job: TableJob, df: DataFrame) -> list[Column]:
    """The key as the destination tells rows apart.

    Integers and text identify the same rows typed or as text, and compare
    faster typed. Other types may lose detail as text (times drop fractions).
    """
    columns = []
    for name in job.key:
        dtype = df.schema[name].dataType
        same = X.is_integer(dtype) or dtype.typeName() == "string"
        key = ref(name) if same else X.canonical_text(name, dtype)
        columns.append(F.collate(key, job.collation) if job.collation and dtype.typeName() == "string" else key)
    return columns


def _check_key(job: TableJob) -> tuple[int, bool]:
    """Row count, and whether the cleaned key tells all rows apart."""
    cleaned = _cleaned(job, job.source.select(*[ref(k) for k in job.key]))
    names = [f"k{i}" for i in range(len(job.key))]
    keys = cleaned.select(*[k.alias(n) for k, n in zip(_destination_key(job, cleaned), names)])
    check = quality.key_check(keys, names).first()
    return check["total_rows"], check["is_key"]


def loaded_rows(job: TableJob, unique: bool) -> DataFrame:
    """What the destination holds after the load, as a plan."""
    job = _with_types(job)
    reason = _reason_name(job)
    rows = _marked_rows(job, unique)
    rows = rows.where(ref(reason).isNull()).drop(reason)
    if job.key and not unique:
        rows = latest_per_key(rows, _destination_key(job, rows), job.order_by)
    return clean.text_table(rows)


def run_table(job: TableJob, folder: str) -> TableResult:
    """Run the copy and write it under ``folder``.

    A proven key makes both the distinct and the upsert unnecessary: a large
    table is then copied in one pass without any shuffle. Otherwise a table
    without a key takes one shuffle for distinct, and one with a key takes one
    for the winners. Refused rows are written by a second, filtered pass, only
    when there are any, with the values of the source. A row whose key is NULL is one of them.
    """
    if job.prepare is not None:
        job = replace(job.prepare(job), prepare=None)
    spark = job.source.sparkSession
    job = _with_types(job)
    if job.key and job.key_is_unique is None:
        src_rows, unique = _check_key(job)
    else:
        src_rows, unique = job.source.count(), bool(job.key and job.key_is_unique)
    if src_rows == 0:
        return TableResult(src_rows=0)

    reason = _reason_name(job)
    columns = job.source.columns
    upsert = bool(job.key) and not unique
    refused, loaded = Observation(), Observation()
    rows = _marked_rows(job, unique)
    good = ref(reason).isNull()

    def null_counts(kept: Column) -> list[Column]:
        return [F.count_if(kept & ref(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]

    # What is observed in the writing stage is exact. Ahead of a shuffle, tasks
    # that run again report twice; there the figure only tells whether the
    # second pass is needed, and counts of merged rows travel with the rows.
    bad_rows = F.count(ref(reason)).alias("refused")
    rows = rows.observe(refused, bad_rows, *([] if upsert else null_counts(good)))
    rows = rows.where(good).drop(reason)
    if upsert:
        count = X.spare_name(columns, "merged_rows")
        rows = latest_per_key(rows, _destination_key(job, rows), job.order_by, count_as=count)
        merged = F.sum(ref(count)).alias("merged")
        rows = rows.observe(loaded, merged, *null_counts(F.lit(True))).drop(count)
    target = f"{folder}/{job.name}/loaded"
    texts = clean.text_table(rows)
    write_version(texts, target)

    dst_rows = spark.read.schema(texts.schema).parquet(target).count()
    quarantined, quarantine = 0, None
    if refused.get["refused"]:
        quarantine = f"{folder}/{job.name}/quarantined"
        write_version(_refused_rows(job, unique), quarantine)
        quarantined = spark.read.parquet(quarantine).count()
    seen = loaded.get if upsert else refused.get
    accepted = (seen["merged"] or 0) if upsert else dst_rows
    missing = src_rows - accepted - quarantined
    if missing < 0 or (missing and not _needs_distinct(job, unique)):
        raise RuntimeError(
            f"{job.name}: {src_rows} rows read, {accepted} loaded and {quarantined} set aside do not add up"
        )
    return TableResult(
        src_rows=src_rows,
        dst_rows=dst_rows,
        duplicates=missing,
        superseded=accepted - dst_rows,
        quarantined=quarantined,
        location=target,
        quarantine=quarantine,
        nulls={c: seen[f"n{i}"] for i, c in enumerate(columns) if seen[f"n{i}"]},
    )
