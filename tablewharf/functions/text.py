"""Column expressions that repair values and render them as text.

Every function takes and returns a ``Column`` (or a list of them), so a whole
table is cleaned in one projection that Catalyst can fuse with its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 25 Unicode White_Space code points that trimming removes.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "no value", compared without regard to case.
SENTINELS = ("nan", "inf", "-inf", "null", "none")

# Digits that the smallest double can have after the point.
FRACTION_DIGITS = 340

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column by its literal name, whatever characters the name holds."""
    return F.col(quoted(name))


def spare_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def is_integer(dtype: T.DataType) -> bool:
    """Integers, and the decimal(20,0) in which unsigned 64-bit integers arrive."""
    return isinstance(dtype, INTEGERS) or dtype == T.DecimalType(20, 0)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, FLOATS)


# Trimming against a set indexes every character of a value. The code of the
# first character and the last byte tell cheaply which values can need it.
_FIRST_CODES = ", ".join(str(ord(space)) for space in WHITESPACE)
_LAST_BYTES = ", ".join(sorted({f"'{space.encode()[-1]:02X}'" for space in WHITESPACE}))
_TRIM = (
    f"CASE WHEN ascii({{0}}) IN ({_FIRST_CODES})"
    f" OR hex(substring(CAST({{0}} AS BINARY), -1, 1)) IN ({_LAST_BYTES})"
    f" THEN trim(BOTH '{WHITESPACE}' FROM {{0}}) ELSE {{0}} END"
)


def trim_text(name: str) -> Column:
    """Strip Unicode whitespace from both ends of a column; inner whitespace stays.

    Written as SQL text, which reaches the JVM in one call: the two lists would
    cost a hundred, and a wide table has hundreds of text columns.
    """
    return F.expr(_TRIM.format(quoted(name)))


def not_finite(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def fill_null_number(c: Column, dtype: T.DataType, value: float = 0) -> Column:
    return F.coalesce(c, F.lit(value).cast(dtype))


def non_finite_to_zero(c: Column, dtype: T.DataType) -> Column:
    return F.when(not_finite(c), F.lit(0.0).cast(dtype)).otherwise(c)


def non_finite_to_null(c: Column) -> Column:
    return F.when(~not_finite(c), c)


def sentinel_to_null(name: str) -> Column:
    # The length test spares long texts the change of case.
    longest = max(len(text) for text in SENTINELS)
    listed = ", ".join(f"'{text}'" for text in SENTINELS)
    return F.expr(
        "CASE WHEN octet_length({0}) <= {1} AND lower({0}) IN ({2}) THEN NULL ELSE {0} END".format(
            quoted(name), longest, listed
        )
    )


def datetime_text(c: Column, dtype: T.DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, without fractions.

    Plain casts are used because ``date_format`` would move zone-free times
    through the session time zone and its daylight-saving gaps.
    """
    if isinstance(dtype, T.DateType):
        return F.concat(c.cast("string"), F.lit(" 00:00:00"))
    return F.substring_index(c.cast("string"), ".", 1)


def duration_text(seconds: Column) -> Column:
    """Seconds as HH:MM:SS; hours may need more than two digits."""
    s = F.floor(seconds).cast("bigint")
    parts = [F.call_function("div", part, F.lit(unit)) for part, unit in ((s, 3600), (s % 3600, 60))]
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", *parts, s % 60))


def percent(part: Column, whole: Column) -> Column:
    """Rounded percentage, 0 when there is nothing to divide by."""
    return (
        F.when(whole > 0, F.round(part / whole * 100))
        .otherwise(0)
        .cast("int")
    )


def number_text(c: Column, dtype: T.DataType) -> Column:
    """Numbers as plain decimal text, never in exponent form."""
    text = c.cast("string")
    if is_float(dtype):
        # Between these bounds the cast is already plain and much cheaper.
        plain = (F.abs(c) >= 0.001) & (F.abs(c) < 1e7)
        # A float widens through its text, which keeps 0.1 from becoming
        # 0.10000000149.
        wide = c if isinstance(dtype, T.DoubleType) else text.cast("double")
        pattern = "0.0" + "#" * (FRACTION_DIGITS - 1)
        return (
            F.when(plain, text)
            .when(c == 0, "0.0")
            .when(not_finite(c), None)
            .otherwise(F.call_function("format_number", wide, F.lit(pattern)))
        )
    if isinstance(dtype, T.DecimalType) and dtype.scale > 6:
        return F.call_function("format_number", c, F.lit("0." + "0" * dtype.scale))
    return text


def canonical_text(name: str, dtype: T.DataType) -> Column:
    """The text a column has in the destination; NULL for every empty notion."""
    c = ref(name)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return sentinel_to_null(name)
    if isinstance(dtype, T.NumericType):
        return number_text(c, dtype)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return datetime_text(c, dtype)
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(dtype, T.DayTimeIntervalType):
        days = F.extract(F.lit("DAY"), c) * 86400
        hours = F.extract(F.lit("HOUR"), c) * 3600
        minutes = F.extract(F.lit("MINUTE"), c) * 60
        return duration_text(days + hours + minutes + F.extract(F.lit("SECOND"), c))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(c)
    if isinstance(dtype, T.BinaryType):  # bytes that are no text are written out
        return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.concat(F.lit("0x"), F.hex(c)))
    return c.cast("string")
