"""Opt-in type recovery for text columns: dates by format, numbers by proof."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.functions import text as X
from tablewharf.functions.text import ref

# Date layouts in the order they are tried: month before day where both fit.
# Slashes, dots and the "T" of ISO times are unified before. Texts with only a
# year or only a time of day are not taken for dates.
_TIME = "[ H:m[:s[.SSSSSS]]]"
_HALF_DAY = " h:m[:s][ ]a"
DATETIME_FORMATS = (
    "yyyy-M-d" + _TIME,
    "M-d-yyyy" + _TIME,
    "d-M-yyyy" + _TIME,
    "yyyyMMdd" + _TIME,
    "MMM d, yyyy" + _TIME,
    "MMMM d, yyyy" + _TIME,
    "MMM d yyyy" + _TIME,
    "MMMM d yyyy" + _TIME,
    "d MMM yyyy" + _TIME,
    "d MMMM yyyy" + _TIME,
    "d-MMM-yyyy" + _TIME,
    "M-d-yy" + _TIME,
    "d-M-yy" + _TIME,
    "yyyy-M",
)
HALF_DAY_FORMATS = tuple(
    layout.replace(_TIME, _HALF_DAY) for layout in DATETIME_FORMATS if layout.endswith(_TIME)
)

# A decimal number, optionally in exponent form, or an infinity. An empty text
# counts as a missing number and does not stop a column from converting.
WHOLE_REGEX = r"^[+-]?\d+$"
DOUBLE_DIGITS = 15
NUMBER_REGEX = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"


# A zone after a time of day: Z, UTC or GMT, or an offset.
_ZONE = r"(?i)(:\d{1,2}(?:\.\d+)?(?:\s?[ap]m)?)\s?(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)$"
# Times written without separators, and with the year at the end, in the order of the layouts above.
_COMPACT = r"^(\d{8})[T ]?(\d{2})(\d{2})(\d{2})(\.\d+)?(?=$|Z|[ +-])"
_YEAR_LAST = r"^([A-Za-z]{3,9} +\d{1,2}) +(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?) (?:(UTC|GMT) )?(\d{4})$"


def lost_datetimes(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(column_name, lost)``: texts of each column that no layout fits, from one aggregate."""
    named = list(columns)
    lost = [ref(c).isNotNull() & (X.trim_text(c) != "") & parse_datetime(c).isNull() for c in named]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(lost)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("lost")) for i, c in enumerate(named)]
    return counts.select(F.inline(F.array(*entries)))


def looks_like_datetime(name: str) -> bool:
    """The name rule: ``date`` or ``time`` anywhere in the column name."""
    lowered = name.lower()
    return "date" in lowered or "time" in lowered


def parse_datetime(name: str, formats: Iterable[str] = DATETIME_FORMATS) -> Column:
    """The first format that fits, NULL when none does.

    A weekday in front is left out, and fractions beyond microseconds are cut. Half days may follow any layout, times may
    be digits alone after such a date, and a year may stand after its time. A time
    with a zone becomes its time in UTC. Others are read as UTC and re-anchored on a zone-free epoch, so no session
    time zone (and no daylight-saving gap) can shift them.
    """
    day = F.regexp_replace(X.trim_text(name), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    dashes = F.regexp_replace(day, r"^(\d+)[/.](\d+)[/.](\d+)", "$1-$2-$3")
    spaced = F.regexp_replace(dashes, r"(?<=\d)T(?=\d)", " ")
    spaced = F.regexp_replace(F.regexp_replace(spaced, _COMPACT, "$1 $2:$3:$4$5"), _YEAR_LAST, "$1 $4 $2 $3")
    spaced = F.regexp_replace(F.rtrim(spaced), r" {2,}", " ")
    cut = F.regexp_replace(spaced, r"(\.\d{6})\d+", "$1")
    zone = F.regexp_extract(cut, _ZONE, 2)
    hours = F.regexp_replace(zone, r"^([+-]\d\d)$", "$1:00")
    offset = F.when(zone.rlike("[0-9]"), F.regexp_replace(hours, r"([+-]\d\d):?(\d\d)", "$1:$2")).otherwise("Z")
    plain = F.concat(F.regexp_replace(cut, _ZONE, "$1"), F.lit(" "), offset)
    half_day = plain.rlike(r"(?i)\d\s?[ap]m ")
    # The half day in capitals; names of months keep their case.
    halved = F.regexp_replace(F.regexp_replace(plain, r"(?i)(?<=\d)\s?am ", " AM "), r"(?i)(?<=\d)\s?pm ", " PM ")

    def first(text: Column, layouts: Iterable[str]) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout + " XXX")) for layout in layouts])

    instant = first(plain, formats)
    if formats is DATETIME_FORMATS:
        instant = F.when(half_day, first(halved, HALF_DAY_FORMATS)).otherwise(instant)
    micros = F.unix_micros(instant)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def coerce_datetimes(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    formats: Iterable[str] = DATETIME_FORMATS,
    skip: Iterable[str] = (),
) -> DataFrame:
    """Turn text columns into timestamps; unreadable values become NULL.

    Without ``columns`` the name rule picks them. Only text columns convert:
    the name rule alone would also hit numbers such as ``lifetime_value``.
    """
    formats = formats if formats is DATETIME_FORMATS else tuple(formats)
    wanted, skipped = None if columns is None else set(columns), set(skip)

    def chosen(f: T.StructField) -> bool:
        named = looks_like_datetime(f.name) if wanted is None else f.name in wanted
        return named and isinstance(f.dataType, T.StringType) and f.name not in skipped

    return df.select(
        *[
            parse_datetime(f.name, formats).alias(f.name) if chosen(f) else ref(f.name)
            for f in df.schema.fields
        ]
    )


def is_number_text(name: str) -> Column:
    trimmed = X.trim_text(name)
    return ref(name).isNull() | (trimmed == "") | trimmed.rlike(NUMBER_REGEX)


def number_types(df: DataFrame, skip: Iterable[str] = ()) -> dict[str, str]:
    """The number type of each text column in which every value is a number.

    One pass for all columns. Whole numbers without gaps stay whole: ``bigint``, from 19
    digits on ``decimal(38,0)``, and beyond 38 digits the column stays text. A column with
    missing values or fractions becomes ``double``, unless it is whole and has more digits than a double keeps.
    """
    skipped = set(skip)
    texts = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skipped
    ]
    if not texts:
        return {}
    checks = []
    for i, name in enumerate(texts):
        trimmed = X.trim_text(name)
        blank = ref(name).isNull() | (trimmed == "")
        digits = F.length(F.regexp_replace(trimmed, r"^[+-]?0*", ""))
        checks += [
            F.bool_and(is_number_text(name)).alias(f"number{i}"),
            F.bool_and(blank | trimmed.rlike(WHOLE_REGEX)).alias(f"whole{i}"),
            F.bool_or(blank).alias(f"gaps{i}"),
            F.max(digits).alias(f"digits{i}"),
        ]
    row = df.agg(*checks).first()
    found = {}
    for i, name in enumerate(texts):
        if not row[f"number{i}"]:
            continue
        digits = row[f"digits{i}"] or 0
        exact = row[f"whole{i}"] and (not row[f"gaps{i}"] or digits > DOUBLE_DIGITS)
        if not exact:
            found[name] = "double"
        elif digits <= 38:
            found[name] = "bigint" if digits <= 18 else "decimal(38,0)"
    return found


def numeric_columns(df: DataFrame) -> list[str]:
    """Text columns that become numbers."""
    return list(number_types(df))


def infer_numbers(
    df: DataFrame, columns: Mapping[str, str] | Iterable[str] | None = None
) -> DataFrame:
    """Convert wholly numeric text columns, leave the others alone.

    ``columns`` skips the proving pass where the answer is already known: types by
    column, or names of columns that become double.
    """
    chosen = number_types(df) if columns is None else columns
    if not isinstance(chosen, Mapping):
        chosen = dict.fromkeys(chosen, "double")
    return df.select(
        *[
            _as_number(f.name, chosen[f.name]).alias(f.name) if f.name in chosen else ref(f.name)
            for f in df.schema.fields
        ]
    )


def _as_number(name: str, dtype: str) -> Column:
    trimmed = X.trim_text(name)
    return F.when(trimmed.rlike(NUMBER_REGEX), trimmed.try_cast(dtype))
