"""Row-level flags and guarded arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import contract as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suppressed(measure: str, footnote: str = "footnote") -> Column:
    """Null because of privacy suppression: value missing AND footnote present.

    Never ``value between 1 and 9``: small published values exist.
    """
    return F.col(measure).isNull() & F.col(footnote).isNotNull()


def any_true(cols: list[str | Column]) -> Column:
    return reduce(lambda x, y: x | y, [col(c) for c in cols])


def month_end(start: str | Column) -> Column:
    return F.last_day(col(start))


def year_end(year: str | Column) -> Column:
    """Dec 31 of a nullable year; null year -> null."""
    y = col(year)
    return F.when(y.isNotNull(), F.make_date(y, F.lit(12), F.lit(31)))


def partial_period(grain="grain", start="start_date", end="end_date", year="year") -> Column:
    g, s, e = col(grain), col(start), col(end)
    return (
        F.when(g == K.GRAIN_MONTH, F.coalesce(e < month_end(s), F.lit(False)))
        .when(g == K.GRAIN_YEAR, F.coalesce(e < year_end(year), F.lit(False)))
        .otherwise(F.lit(False))
    )


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num/den, null when den is null or <= 0 (never a division error)."""
    d = col(den)
    return F.when(d > 0, F.try_divide(col(num), d))


def pct(num: str | Column, den: str | Column) -> Column:
    """100*num/den with a null (not an error) on a zero denominator."""
    return F.try_divide(F.lit(100.0) * col(num), col(den))
