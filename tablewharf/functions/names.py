"""Names: dated snapshot names, comma lists and shell-style patterns."""

from __future__ import annotations

import fnmatch
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewharf.functions.text import WHITESPACE

# Placeholders of a snapshot name, each with the start and length
# of its part in a "yyyy-MM-dd HH:mm:ss" text.
NAME_PLACEHOLDERS = {
    "{YYYY}": (1, 4),
    "{MM}": (6, 2),
    "{DD}": (9, 2),
    "{HH}": (12, 2),
    "{mm}": (15, 2),
    "{ss}": (18, 2),
}

# Fixed value: marks a source name that stands for the newest match.
LATEST_PREFIX = "LATEST:"


def snapshot_name(template: Column | str, at: Column) -> Column:
    """Fill the placeholders of ``template`` from one moment in time.

    Pass one frozen timestamp per run: all tables of a run then land in the
    same snapshot, however long the run takes.
    """
    name = F.lit(template) if isinstance(template, str) else template
    text = at.cast("string")
    for placeholder, (start, length) in NAME_PLACEHOLDERS.items():
        name = F.replace(name, F.lit(placeholder), F.substring(text, start, length))
    return name


def namespace_name(name: Column) -> Column:
    """Spark namespaces take no dots or hyphens; both become underscores."""
    return F.translate(name, ".-", "__")


def snapshot_name_text(spark, template: str, at: datetime) -> str:
    """The same rule for one name on the driver (a single literal row)."""
    # As text, so that no time zone takes part.
    moment = F.lit(f"{at:%Y-%m-%d %H:%M:%S}")
    row = spark.range(1).select(namespace_name(snapshot_name(template, moment))).first()
    return row[0]


def split_names(text: Column) -> Column:
    """``"a, b ,c"`` as an array of trimmed names."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item, F.lit(WHITESPACE)))


def glob_regex(pattern: str) -> str:
    """A shell-style pattern as a regular expression for ``rlike``.

    ``rlike`` searches anywhere, so the expression is anchored at both ends.
    """
    body = fnmatch.translate(pattern)
    return "^" + body.replace(r"\Z", r"\z")


def matches_glob(name: Column, pattern: str) -> Column:
    return name.rlike(glob_regex(pattern))
