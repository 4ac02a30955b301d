"""Report formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.flags import col


def month_label(d: str | Column) -> Column:
    """'January 1999'."""
    return F.date_format(col(d), "MMMM yyyy")


def short_month_label(d: str | Column) -> Column:
    """'Jan 1999'."""
    return F.date_format(col(d), "MMM yyyy")


def case_label(geo: str | Column, d: str | Column) -> Column:
    return F.concat_ws(" ", col(geo), short_month_label(d))
