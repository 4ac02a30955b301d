"""Typed parsing of text columns (strict dates, lenient numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_date(col: str | Column, fmt: str) -> Column:
    """Parse a date; a non-null value that does not parse fails the job.

    Independent of the session's ANSI setting: the failure is explicit.
    """
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.try_to_date(c, fmt)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("malformed date: "), c))).otherwise(parsed).cast("date")


def lenient_int(col: str | Column) -> Column:
    """Integer or null: any numeric text with an integral value ("2020",
    "2020.0", "2.02e3") parses; other text becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    d = c.try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("int"))


def count_to_double(col: str | Column) -> Column:
    """Thousands-separated count -> double; anything unparsable -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, ",", "").try_cast("double")
