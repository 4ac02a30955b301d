"""Monthly lag panel, time splits and expanding folds.

All lags share one window spec partitioned by geography and ordered by the
period start, so Catalyst plans a single shuffle + sort for every lag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.functions import features as X
from tessera.operators.slices import complete_periods, grain_slice, in_domain, require_levels


def _covariates(measure: str, covariates) -> list[str]:
    """Covariates other than the target (the target's lag1 is already a feature)."""
    return [c for c in covariates if c != measure]


def lag_columns(measure: str = "a", covariates=("total", "b")) -> list[str]:
    return [f"lag1_{measure}", f"lag2_{measure}", f"lag3_{measure}", f"rolling3_{measure}",
            *[f"lag1_{c}" for c in _covariates(measure, covariates)]]


NUMERIC_FEATURES_SUFFIX = ["month_sin", "month_cos", "time_index"]


def numeric_features(measure: str = "a", covariates=("total", "b")) -> list[str]:
    return lag_columns(measure, covariates) + NUMERIC_FEATURES_SUFFIX


def monthly_panel(clean: DataFrame, measure: str = "a", covariates=("total", "b"),
                  midpoint: float = K.MIDPOINT, base_year: int = K.BASE_YEAR) -> DataFrame:
    """Per-geography monthly series with leak-free lag features.

    Nulls are filled with ``midpoint`` for lag inputs only; the target keeps
    its null. Lags are row lags (a missing month would shift them; see
    ``gap_audit``). ``rolling3`` is the mean of the previous three rows and is
    null unless all three exist.
    """
    covariates = _covariates(measure, covariates)
    cols = [measure, *covariates]
    p = complete_periods(in_domain(grain_slice(clean, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)))
    for c in cols:
        require_levels(p, c, ["geo"])
    p = p.select("geo", "start_date", "month", *cols,
                 *[F.coalesce(F.col(c), F.lit(midpoint)).alias(f"__{c}_for_lag") for c in cols])
    w = Window.partitionBy("geo").orderBy("start_date")
    prev3 = w.rowsBetween(-3, -1)
    lag_in = F.col(f"__{measure}_for_lag")
    return p.select(
        "geo",
        "start_date",
        F.col(measure).cast("double").alias(measure),
        F.lag(lag_in, 1).over(w).alias(f"lag1_{measure}"),
        F.lag(lag_in, 2).over(w).alias(f"lag2_{measure}"),
        F.lag(lag_in, 3).over(w).alias(f"lag3_{measure}"),
        F.when(F.count(lag_in).over(prev3) == 3, F.avg(lag_in).over(prev3)).alias(f"rolling3_{measure}"),
        *[F.lag(F.col(f"__{c}_for_lag"), 1).over(w).alias(f"lag1_{c}") for c in covariates],
        X.month_sin("month").alias("month_sin"),
        X.month_cos("month").alias("month_cos"),
        X.time_index("start_date", base_year).alias("time_index"),
    )


def lag_panel(clean: DataFrame, measure: str = "a", covariates=("total", "b"), **kw) -> DataFrame:
    """M5: model rows = panel rows with every lag and the target present."""
    return monthly_panel(clean, measure, covariates, **kw).na.drop(
        subset=lag_columns(measure, covariates) + [measure])


def gap_audit(clean: DataFrame) -> DataFrame:
    """Months missing inside each geography's series (row lags would cross them)."""
    p = complete_periods(in_domain(grain_slice(clean, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)))
    w = Window.partitionBy("geo").orderBy("start_date")
    return (p.select("geo", "start_date", F.lag("start_date").over(w).alias("prev"))
            .filter(F.col("prev").isNotNull() & (F.months_between("start_date", "prev") > 1)))


def observed_series(clean: DataFrame, measure: str = "a") -> DataFrame:
    """(geo, start_date, measure) of the complete months whose count is published; suppressed months are gaps."""
    p = complete_periods(in_domain(grain_slice(clean, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)))
    return require_levels(p, measure, ["geo"]).where(F.col(measure).isNotNull()).select("geo", "start_date", F.col(measure).cast("double").alias(measure))


def calendar_lags(series: DataFrame, measure: str, lags=(1, 2, 3), by: str = "geo") -> DataFrame:
    """W1, W2 by the calendar: ``cal_lag<k>`` is the value k months before, null if that month is missing, and ``cal_rolling<n>`` the mean of
    the n months before, null unless all are there; ``row_lag<k>`` is the value k rows before. RANGE frames over the month number; months are distinct within ``by``."""
    month = F.year("start_date") * 12 + F.month("start_date")
    w = Window.partitionBy(by).orderBy("__month")
    n = max(lags)
    before = w.rangeBetween(-n, -1)
    v = F.col(measure)
    return series.withColumn("__month", month).select(
        *series.columns, *[F.lag(v, k).over(w).alias(f"row_lag{k}") for k in lags], *[F.max(v).over(w.rangeBetween(-k, -k)).alias(f"cal_lag{k}") for k in lags],
        F.when(F.count(v).over(before) == n, F.avg(v).over(before)).alias(f"cal_rolling{n}"))


def series_gaps(series: DataFrame, by: str = "geo") -> DataFrame:
    """(by, start_date, prev, missing_months): the rows before which months are missing."""
    w = Window.partitionBy(by).orderBy("start_date")
    rows = series.select(by, "start_date", F.lag("start_date").over(w).alias("prev"))
    missing = F.months_between("start_date", "prev").cast("int") - 1
    return rows.withColumn("missing_months", missing).where("missing_months > 0")


def tag_split(panel: DataFrame, train_end: str = K.TRAIN_END, test_start: str = K.TEST_START,
              test_end: str = K.TEST_END) -> DataFrame:
    """M7: chronological train/test tag (rows in neither get null)."""
    d = F.col("start_date")
    return panel.withColumn(
        "split",
        F.when(d < F.lit(train_end).cast("date"), F.lit("train"))
        .when(d.between(F.lit(test_start).cast("date"), F.lit(test_end).cast("date")), F.lit("test")),
    )


def tag_three_way(panel: DataFrame) -> DataFrame:
    """M7: fit / validation / test split for the network."""
    d = F.col("start_date")
    return panel.withColumn(
        "split",
        F.when(d < F.lit(K.FIT_END).cast("date"), F.lit("fit"))
        .when(d.between(F.lit(K.VALID_START).cast("date"), F.lit(K.VALID_END).cast("date")), F.lit("validation"))
        .when(d.between(F.lit(K.TEST_START).cast("date"), F.lit(K.TEST_END).cast("date")), F.lit("test")),
    )


def fold_rows(panel: DataFrame, folds=K.FOLDS) -> DataFrame:
    """M8: every (fold, role) membership of every row from ONE scan.

    A row is 'train' for each fold starting after it and 'validation' for the
    fold whose closed range holds it.
    """
    arr = F.array(*[
        F.struct(F.lit(lbl).alias("fold"), F.lit(s).cast("date").alias("fs"), F.lit(e).cast("date").alias("fe"))
        for lbl, s, e in folds
    ])
    d = F.col("start_date")
    tagged = panel.withColumn("__f", F.explode(arr)).select(
        "*",
        F.col("__f.fold").alias("fold"),
        F.when(d < F.col("__f.fs"), F.lit("train"))
        .when(d.between(F.col("__f.fs"), F.col("__f.fe")), F.lit("validation")).alias("role"),
    ).drop("__f")
    return tagged.filter(F.col("role").isNotNull())


def fold_sizes(panel: DataFrame, folds=K.FOLDS) -> DataFrame:
    r = fold_rows(panel, folds)
    return r.groupBy("fold").agg(
        F.sum(F.when(F.col("role") == "train", 1).otherwise(0)).cast("bigint").alias("train_rows"),
        F.sum(F.when(F.col("role") == "validation", 1).otherwise(0)).cast("bigint").alias("validation_rows"),
    )
