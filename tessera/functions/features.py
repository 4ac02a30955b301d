"""Model-side scalar expressions (targets, seasonality, residual algebra)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.flags import col


def log_target(y: str | Column) -> Column:
    return F.log1p(col(y).cast("double"))


def clip_prediction(p: str | Column) -> Column:
    """max(p, 0) that keeps a null prediction null (greatest() would not)."""
    c = col(p)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def inverse_log_target(p: str | Column) -> Column:
    return clip_prediction(F.expm1(col(p)))


def month_sin(month: str | Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * col(month).cast("double") / F.lit(12.0))


def month_cos(month: str | Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * col(month).cast("double") / F.lit(12.0))


def time_index(date: str | Column, base_year: int) -> Column:
    d = col(date)
    return (F.year(d) - F.lit(base_year)) * 12 + F.month(d) - 1


def residual_target(y: str | Column, base: str | Column) -> Column:
    """log1p(y) - log1p(base): zero means "same as the persistence forecast"."""
    return F.log1p(col(y).cast("double")) - F.log1p(col(base).cast("double"))


def residual_reconstruct(base: str | Column, residual: str | Column) -> Column:
    return clip_prediction(F.expm1(F.log1p(col(base).cast("double")) + col(residual)))


def signed_error(y: str | Column, p: str | Column) -> Column:
    return col(p) - col(y).cast("double")


def absolute_error(y: str | Column, p: str | Column) -> Column:
    return F.abs(col(y).cast("double") - col(p))
