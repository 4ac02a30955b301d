"""Forecast evaluation (E1-E7): metrics as one aggregate, per model/fold."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.features import clip_prediction
from tessera.operators.ranks import values_at_ranks
from tessera.session import write_scratch


def metric_columns(y: str | Column, pred: str | Column, clip: bool = True) -> list[Column]:
    """MAE, RMSE, R2, WAPE% (predictions clipped at 0 first, like the source)."""
    yv = (F.col(y) if isinstance(y, str) else y).cast("double")
    p = F.col(pred) if isinstance(pred, str) else pred
    p = clip_prediction(p) if clip else p
    e = yv - p
    return [
        F.count(yv).cast("bigint").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        # undefined (NULL) when y is constant / sums to zero, never a division error
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(yv) * F.count(yv))).alias("r2"),
        F.try_divide(F.lit(100.0) * F.sum(F.abs(e)), F.sum(yv)).alias("wape_pct"),
    ]


def regression_metrics(df: DataFrame, y: str, pred: str, by: list[str] | None = None,
                       clip: bool = True) -> DataFrame:
    by = by or []
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*metric_columns(y, pred, clip))


def long_model_metrics(df: DataFrame, y: str, models: dict[str, str], by: list[str] | None = None,
                       baseline: str | None = None) -> DataFrame:
    """One metrics row per model, all from one scan (models exploded).

    With ``baseline`` the baseline's MAE on the same rows is carried along
    as ``base_mae`` (no self-join needed for relative improvement).
    """
    by = by or []
    arr = F.array(*[F.struct(F.lit(name).alias("model"), F.col(col).cast("double").alias("p"))
                    for name, col in models.items()])
    extra = [F.col(baseline).cast("double").alias("__b")] if baseline else []
    long = df.select(*by, F.col(y).alias("__y"), *extra, F.explode(arr).alias("__m")).select(
        *by, "__y", *(["__b"] if baseline else []), F.col("__m.model").alias("model"), F.col("__m.p").alias("__p"))
    aggs = metric_columns("__y", "__p")
    if baseline:
        aggs.append(F.avg(F.abs(F.col("__y").cast("double") - clip_prediction(F.col("__b")))).alias("base_mae"))
    return long.groupBy(*by, "model").agg(*aggs)


def improvement_pct(base: str | Column, model: str | Column) -> Column:
    """100*(base-model)/base (positive = model better)."""
    b = F.col(base) if isinstance(base, str) else base
    m = F.col(model) if isinstance(model, str) else model
    return F.try_divide(F.lit(100.0) * (b - m), b)


def acceptance(model_mae, model_rmse, model_wape, base_mae, base_rmse, base_wape) -> Column:
    """E5: accept only if MAE, RMSE and WAPE all beat the baseline."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return (c(model_mae) < c(base_mae)) & (c(model_rmse) < c(base_rmse)) & (c(model_wape) < c(base_wape))


def conformal_half_widths(df: DataFrame, residual: str, block: str, coverage: float = 0.9) -> DataFrame:
    """Per block of calibration rows the half-width that a new row's absolute residual stays within with probability ``coverage``: the
    value at rank ceil((n + 1) * coverage) of the block's n absolute residuals, null where the block is too small for it. (block, n, rank, half_width)."""
    rows = df.select(F.col(block), F.abs(F.col(residual)).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    share = Decimal(str(coverage))
    sizes = rows.groupBy(block).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    sizes = write_scratch(sizes.withColumn("place", F.ceil((F.col("n") + 1) * F.lit(share)).cast("long")), "conformal-blocks")
    wanted = sizes.where("place <= n").select(block, "lo", "hi", (F.col("place") - 1).alias("rank"))
    found = values_at_ranks(rows, wanted, [block]).select(F.col(block).alias("__b"), "value")
    joined = sizes.join(found, sizes[block].eqNullSafe(F.col("__b")), "left")
    return joined.select(block, "n", F.col("place").alias("rank"), F.col("value").alias("half_width"))


def monthly_errors(df: DataFrame, y: str, pred: str, month: str = "start_date", geo: str = "geo") -> DataFrame:
    """E1 per month, with the geography of the largest absolute error (ties: the first by name)."""
    off = F.abs(F.col(y).cast("double") - clip_prediction(F.col(pred)))
    worst = F.min(F.when(off.isNotNull(), F.struct((-off).alias("v"), F.col(geo).alias("g"))))
    g = df.groupBy(month).agg(*metric_columns(y, pred), worst.alias("w"))
    return g.select(month, "n", "mae", "rmse", "wape_pct", F.col("w.g").alias("worst_geo"), (-F.col("w.v")).alias("worst_error"))


def split_coverage(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and first/last period per split."""
    return df.filter(F.col(split_col).isNotNull()).groupBy(split_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.min("start_date").alias("first_month"),
        F.max("start_date").alias("last_month"),
    )
