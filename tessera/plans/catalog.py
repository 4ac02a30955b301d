"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the driver's tables through the materialized cube
(``load_clean`` / ``load_text``), so its work grows with ``lineitem``.
Output conventions shared with the oracle SQL: dates as ISO strings, counts
BIGINT, computed ratios DOUBLE rounded to 6 places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.functions import features as X
from tessera.functions import fmt
from tessera.functions.flags import month_end, pct, year_end
from tessera.operators import describe as D
from tessera.operators import evaluate as E
from tessera.operators import intervals as IV
from tessera.operators import panel as P
from tessera.operators import profile as PR
from tessera.operators import quality as Q
from tessera.operators import slices as S
from tessera.operators.clean import CLEAN_COLUMNS
from tessera.session import bounded_broadcast, scratch_path, write_scratch
from tessera.sources.cube import read_table
from tessera.sources.store import load_clean, load_text, once, write_audit
from tessera.sources.text import content_fingerprint
from tessera.sources.text import source_profile as _source_profile

MEASURE = "a"
R = 6  # rounding of computed doubles in outputs


def _r(c, n: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _iso(c: str):
    return F.col(c).cast("string").alias(c)


def _clean(spark, d):
    return load_clean(spark, d)


def _national(clean: DataFrame, grain: str) -> DataFrame:
    return S.grain_slice(clean, grain, geo=K.GEO_ALL, sex=K.SEX_ALL, band=K.BAND_ALL)


def _geo_totals(clean: DataFrame) -> DataFrame:
    return S.require_levels(S.in_domain(S.grain_slice(clean, K.GRAIN_TOTAL, sex=K.SEX_ALL, band=K.BAND_ALL)))


def _panel(spark, d, measure: str = MEASURE) -> DataFrame:
    return P.lag_panel(_clean(spark, d), measure)


def _test_rows(spark, d, measure: str = MEASURE) -> DataFrame:
    """Held-out rows scored by the mean-of-3 forecast (no model needed)."""
    t = P.tag_split(_panel(spark, d, measure)).filter(F.col("split") == "test")
    pred = X.clip_prediction(F.col(f"rolling3_{measure}"))
    return t.withColumn("prediction", pred).withColumn(
        "absolute_error", X.absolute_error(measure, "prediction")).withColumn(
        "error", X.signed_error(measure, "prediction"))


# --------------------------------------------------------------------------
# Sources and cleaning
# --------------------------------------------------------------------------

def q_scan_text_cube(spark, d):
    return load_text(spark, d)


def q_source_profile(spark, d):
    return _source_profile(load_text(spark, d)).select("raw_rows", "raw_columns")


def q_clean_types(spark, d):
    c = _clean(spark, d)
    return c.select(*[_iso(x) if x in K.DATE_COLS else F.col(x) for x in CLEAN_COLUMNS])


def q_suppression_flags(spark, d):
    c = _clean(spark, d)
    return c.select(*K.KEY_COLS, *[f"{m}_suppressed" for m in K.MEASURES], "has_suppression")


def q_partial_period(spark, d):
    c = _clean(spark, d)
    return c.select(*K.KEY_COLS, _iso("start_date"), _iso("end_date"),
                    month_end("start_date").cast("string").alias("month_end"),
                    year_end("year").cast("string").alias("year_end"), "is_partial_period")


def q_safe_share(spark, d):
    c = _clean(spark, d)
    return c.select(*K.KEY_COLS, "a", "total", "a_share_of_total")


# --------------------------------------------------------------------------
# Slices and domains
# --------------------------------------------------------------------------

def q_grain_slice(spark, d):
    c = _clean(spark, d)
    s = S.in_domain(S.grain_slice(c, K.GRAIN_YEAR, sex=K.SEX_ALL, band=K.BAND_ALL, year=[1996, 1997, 1998]))
    return s.select("geo", "year", _iso("start_date"), _iso("end_date"), *K.MEASURES, "is_partial_period")


def q_national_monthly(spark, d):
    n = S.complete_periods(_national(_clean(spark, d), K.GRAIN_MONTH))
    return n.select(_iso("start_date"), "a", "total", _r(pct("a", "total")).alias("a_pct_total"))


def q_national_totals(spark, d):
    n = _national(_clean(spark, d), K.GRAIN_TOTAL)
    return n.select("a", "total", _r(F.col("a_share_of_total") * 100, 2).alias("a_share_pct"))


def q_geo_domain(spark, d):
    return S.geo_domain(_clean(spark, d))


def q_domain_semi_join(spark, d):
    c = _clean(spark, d)
    rows = S.grain_slice(c, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)
    return S.semi_join_domain(rows, S.geo_domain(c)).select("geo", _iso("start_date"), "a", "total")


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------

def q_quality_summary(spark, d):
    s = Q.quality_summary(_clean(spark, d))
    return s.select(*[_iso(c) if c in ("data_as_of", "start_min", "end_max") else F.col(c) for c in s.columns])


def q_value_counts(spark, d):
    c = _clean(spark, d)
    return Q.value_counts(c, "grain").unionByName(Q.value_counts(c, "footnote", dropna=False))


def q_duplicate_audit(spark, d):
    return Q.duplicate_audit(load_text(spark, d))


def q_missingness(spark, d):
    m = Q.missingness(_clean(spark, d))
    return m.select("field", "missing_count", _r("missing_percent").alias("missing_percent"))


def q_missingness_all(spark, d):
    m = Q.missingness(_clean(spark, d), CLEAN_COLUMNS)
    return m.select("field", "missing_count", _r("missing_percent").alias("missing_percent"))


def q_rule_audit(spark, d):
    return Q.rule_audit(_clean(spark, d))


def q_band_reconcile(spark, d):
    r = Q.band_reconcile(_clean(spark, d), "total")
    return r.select("grain", _iso("start_date"), "geo", "sex", "bands_sum", "all_value", "diff")


# --------------------------------------------------------------------------
# Descriptive statistics
# --------------------------------------------------------------------------

def q_iqr_bounds(spark, d):
    b = D.iqr_bounds(_geo_totals(_clean(spark, d)), "a")
    return b.select(*[_r(c).alias(c) for c in ["q1", "q3", "iqr", "fence"]])


def q_iqr_flags(spark, d):
    f = D.iqr_flags(_geo_totals(_clean(spark, d)), "a", ["grain", "sex", "band"])
    return f.select("geo", "a", _r("fence").alias("fence"), "iqr_flag")


def _national_bands(spark, d) -> DataFrame:
    c = _clean(spark, d)
    return S.grain_slice(c, K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEX_ALL, band=K.EXCLUSIVE_BAND_LABELS)


def q_senior_share(spark, d):
    b = S.require_levels(_national_bands(spark, d))
    senior = F.when(F.col("band").isin(K.SENIOR_BANDS), F.col("a"))
    return b.agg(F.sum(senior).alias("senior_a"), F.sum("a").alias("bands_a")).select(
        "senior_a", "bands_a", _r(pct("senior_a", "bands_a")).alias("senior_share_pct"))


def q_age_profile(spark, d):
    b = D.share_of_slice(_national_bands(spark, d), "a", ["grain", "geo", "sex"], "share_a")
    return b.select("band", D.band_ordinal().alias("ordinal"), "a", "total", _r("share_a").alias("share_a"),
                    _r(pct("a", "total")).alias("a_pct_total"))


def q_min_count_sum(spark, d):
    c = _clean(spark, d)
    s = S.in_domain(S.grain_slice(c, K.GRAIN_TOTAL, sex=K.SEX_ALL, band=K.SENIOR_BANDS))
    return D.min_count_sum(s, "a", ["geo"], len(K.SENIOR_BANDS), "senior_a")


def q_extremes(spark, d):
    c = _clean(spark, d)
    nm = S.require_levels(S.complete_periods(_national(c, K.GRAIN_MONTH)))
    month = nm.agg(
        D.arg_max(F.col("a"), F.col("start_date")).alias("peak_month"),
        F.max("a").alias("peak_a"),
        D.arg_min(F.col("a"), F.col("start_date")).alias("low_month"),
        F.min("a").alias("low_a"),
    )
    bands = _national_bands(spark, d).withColumn("ordinal", D.band_ordinal())
    bands = bands.withColumn("pct_total", pct("a", "total"))
    band = bands.agg(
        D.arg_max(F.col("a"), F.col("ordinal")).alias("max_band_ordinal"),
        D.arg_max(F.col("pct_total"), F.col("ordinal")).alias("max_pct_band_ordinal"),
    )
    geos = _geo_totals(c).withColumn("share", pct("a", "total")).agg(
        D.arg_max(F.col("share"), F.col("geo")).alias("max_share_geo"),
        D.arg_min(F.col("share"), F.col("geo")).alias("min_share_geo"),
    )
    # three one-row aggregates combined without a join: union + max per column
    cols = {"peak_month": "date", "peak_a": "double", "low_month": "date", "low_a": "double",
            "max_band_ordinal": "int", "max_pct_band_ordinal": "int",
            "max_share_geo": "string", "min_share_geo": "string"}

    def pad(df):
        return df.select(*[(F.col(k) if k in df.columns else F.lit(None)).cast(t).alias(k) for k, t in cols.items()])

    out = pad(month).unionByName(pad(band)).unionByName(pad(geos)).agg(*[F.max(k).alias(k) for k in cols])
    band_name = lambda o: F.element_at(F.array(*[F.lit(b) for b in K.EXCLUSIVE_BAND_LABELS]), F.col(o) + 1)  # noqa
    return out.select(_iso("peak_month"), "peak_a", _iso("low_month"), "low_a",
                      band_name("max_band_ordinal").alias("max_band"),
                      band_name("max_pct_band_ordinal").alias("max_pct_band"),
                      "max_share_geo", "min_share_geo")


def _geo_share(spark, d) -> DataFrame:
    return _geo_totals(_clean(spark, d)).select("geo", "a", "total", pct("a", "total").alias("a_pct_total"))


def q_geo_share(spark, d):
    g = _geo_share(spark, d)
    return g.select("geo", "a", "total", _r("a_pct_total").alias("a_pct_total")).orderBy(
        F.desc("a_pct_total"), "geo")


def q_geo_share_stats(spark, d):
    g = _geo_share(spark, d).withColumn("slice", F.lit(0))
    median = bounded_broadcast(D.quantiles(g, "a_pct_total", (0.5,), ["slice"]), D.MAX_SLICES)
    return g.groupBy("slice").agg(
        F.max("a_pct_total").alias("max_share"),
        F.min("a_pct_total").alias("min_share"),
        (F.max("a_pct_total") - F.min("a_pct_total")).alias("range_points"),
        D.arg_max(F.col("a_pct_total"), F.col("geo")).alias("max_geo"),
        D.arg_min(F.col("a_pct_total"), F.col("geo")).alias("min_geo"),
    ).join(median.withColumnRenamed("q50", "median_share"), "slice").select(*[_r(c).alias(c) for c in ["max_share", "min_share", "median_share", "range_points"]],
             "max_geo", "min_geo")


def _sex_band_pivot(spark, d) -> DataFrame:
    c = _clean(spark, d)
    s = S.grain_slice(c, K.GRAIN_TOTAL, geo=K.GEO_ALL, band=K.EXCLUSIVE_BAND_LABELS)
    return D.guarded_pivot(s, ["band"], "sex", K.SEX_PARTS, "a", prefix="a_")


def q_sex_age_pivot(spark, d):
    c = _clean(spark, d)
    s = S.in_domain(S.grain_slice(c, K.GRAIN_TOTAL, band=K.BAND_ALL))
    p = D.guarded_pivot(s, ["geo"], "sex", K.SEXES, "a", prefix="a_")
    p0, p1 = (f"a_{x}" for x in K.SEX_PARTS)
    return p.withColumn("p0_share", _r(pct(p0, F.col(p0) + F.col(p1))))


def q_sex_age_ratio(spark, d):
    p = _sex_band_pivot(spark, d)
    dim = D.band_dimension(spark)
    p0, p1 = (f"a_{x}" for x in K.SEX_PARTS)
    j = dim.join(p, "band", "left")
    return j.select("band", "ordinal", p0, p1,
                    _r(F.try_divide(F.col(p1), F.col(p0))).alias("p1_to_p0")).orderBy("ordinal")


def q_sex_age_long(spark, d):
    p = _sex_band_pivot(spark, d)
    cols = [f"a_{x}" for x in K.SEX_PARTS]
    long = D.unpivot(p, ["band"], cols, "sex", "a")
    return long.select("band", F.regexp_replace("sex", "^a_", "").alias("sex"), "a")


SPEARMAN_COLS = K.MEASURES


def q_spearman_matrix(spark, d):
    n = S.require_levels(S.complete_periods(_national(_clean(spark, d), K.GRAIN_MONTH)))
    return D.spearman_long(n, SPEARMAN_COLS).select("x", "y", _r("rho").alias("rho"))


def q_histogram18(spark, d):
    h = D.histogram(_geo_totals(_clean(spark, d)), "a", 18, ["grain", "sex", "band"])
    return h.select("bin", _r("bin_lo").alias("bin_lo"), _r("bin_hi").alias("bin_hi"), "n")


def q_decline_from_peak(spark, d):
    nm = S.require_levels(S.complete_periods(_national(_clean(spark, d), K.GRAIN_MONTH)))
    agg = nm.agg(
        D.arg_max(F.col("a"), F.col("start_date")).alias("peak_month"),
        F.max("a").alias("peak_a"),
        F.max_by("a", "start_date").alias("last_a"),
        F.max("start_date").alias("last_month"),
    )
    return agg.select(_iso("peak_month"), "peak_a", _iso("last_month"), "last_a",
                      _r(pct(F.col("peak_a") - F.col("last_a"), "peak_a")).alias("decline_pct"))


def q_top_share(spark, d):
    top = D.top_n(_geo_share(spark, d), "a_pct_total", 15, "geo")
    return top.select("geo", _r("a_pct_total").alias("a_pct_total"))


# --------------------------------------------------------------------------
# Profiles and groups
# --------------------------------------------------------------------------

def _profile(spark, d) -> DataFrame:
    return PR.geo_profile(_clean(spark, d))


def _profile_groups(spark, d) -> DataFrame:
    return PR.attach_groups(_profile(spark, d), read_table(spark, d, "nation", "n_name", "n_regionkey"))


def q_geo_profile(spark, d):
    p = _profile(spark, d)
    return p.select("geo", *[_r(f).alias(f) for f in PR.PROFILE_FEATURES])


def q_standardize(spark, d):
    z = PR.standardize(_profile(spark, d), PR.PROFILE_FEATURES)
    return z.select("geo", *[_r(f).alias(f) for f in PR.PROFILE_FEATURES])


def q_group_profile(spark, d):
    g = PR.group_profile(_profile_groups(spark, d), PR.PROFILE_FEATURES)
    return g.select("grp", "size", *[_r(f).alias(f) for f in PR.PROFILE_FEATURES])


def q_group_profile_z(spark, d):
    z = PR.group_profile_z(_profile_groups(spark, d), PR.PROFILE_FEATURES)
    return z.select("grp", *[_r(f).alias(f) for f in PR.PROFILE_FEATURES])


def q_group_members(spark, d):
    return PR.group_members(_profile_groups(spark, d)).select("grp", "members_text")


def q_relabel_groups(spark, d):
    r = PR.relabel_groups(_profile_groups(spark, d), "a_pct_total")
    return r.select("geo", F.col("grp").alias("old_group"), "new_group")


# --------------------------------------------------------------------------
# Panel, features and evaluation (prediction = mean of previous three)
# --------------------------------------------------------------------------

def q_lag_panel(spark, d, measure=MEASURE):
    p = _panel(spark, d, measure)
    return p.select("geo", _iso("start_date"), measure, *P.lag_columns(measure),
                    _r("month_sin", 9).alias("month_sin"), _r("month_cos", 9).alias("month_cos"), "time_index")


def q_log_target(spark, d):
    p = _panel(spark, d)
    return p.select("geo", _iso("start_date"), MEASURE, _r(X.log_target(MEASURE), 9).alias("log_target"))


def q_residual_target(spark, d):
    p = _panel(spark, d)
    return p.select("geo", _iso("start_date"), MEASURE, f"lag1_{MEASURE}",
                    _r(X.residual_target(MEASURE, f"lag1_{MEASURE}"), 9).alias("residual_target"))


def q_residual_reconstruct(spark, d):
    p = _panel(spark, d)
    base, r3 = f"lag1_{MEASURE}", f"rolling3_{MEASURE}"
    resid = X.residual_target(r3, base)
    return p.select("geo", _iso("start_date"), base, r3,
                    _r(X.residual_reconstruct(base, resid)).alias("reconstructed"))


def q_season_features(spark, d):
    c = _clean(spark, d)
    m = S.complete_periods(S.in_domain(S.grain_slice(c, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)))
    return m.select("geo", _iso("start_date"), F.year("start_date").alias("year"),
                    F.month("start_date").alias("month"),
                    _r(X.month_sin("month"), 9).alias("month_sin"), _r(X.month_cos("month"), 9).alias("month_cos"),
                    X.time_index("start_date", K.BASE_YEAR).alias("time_index"))


def q_month_labels(spark, d):
    n = _national(_clean(spark, d), K.GRAIN_MONTH)
    return n.select(_iso("start_date"), fmt.month_label("start_date").alias("long_label"),
                    fmt.short_month_label("start_date").alias("short_label"))


def q_forecast_errors(spark, d, measure=MEASURE):
    t = _test_rows(spark, d, measure)
    return t.select("geo", _iso("start_date"), measure, f"lag1_{measure}", _r("prediction").alias("prediction"),
                    _r("absolute_error").alias("absolute_error"), _r("error").alias("error"))


def q_expanding_folds(spark, d):
    return P.fold_sizes(_panel(spark, d))


def q_time_splits(spark, d):
    p = _panel(spark, d)
    three = E.split_coverage(P.tag_three_way(p))
    train = E.split_coverage(P.tag_split(p).filter(F.col("split") == "train"))
    out = three.unionByName(train)
    return out.select("split", "rows", _iso("first_month"), _iso("last_month"))


def q_forecast_monthly(spark, d):
    t = _test_rows(spark, d)
    g = t.groupBy("start_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum(MEASURE).alias("actual"),
        F.sum("prediction").alias("predicted"),
        F.sum(f"lag1_{MEASURE}").alias("baseline"),
    )
    return g.select(_iso("start_date"), "rows", "actual", _r("predicted").alias("predicted"), "baseline")


def q_worst_errors(spark, d):
    t = _test_rows(spark, d).withColumn("__k", F.concat_ws("|", "geo", F.col("start_date").cast("string")))
    w = t.orderBy(F.desc("absolute_error"), F.asc("__k")).limit(10)
    return w.select(fmt.case_label("geo", "start_date").alias("label"),
                    _r(MEASURE, 1).alias("actual"), _r("prediction", 1).alias("pred"),
                    _r("absolute_error", 1).alias("abs_error"))


def _metric_cols(prefix: str = ""):
    return [_r(m).alias(prefix + m) for m in ["mae", "rmse", "r2", "wape_pct"]]


def q_baseline_metrics(spark, d, measure=MEASURE):
    t = _test_rows(spark, d, measure)
    m = E.regression_metrics(t, measure, f"lag1_{measure}")
    return m.select("n", *_metric_cols())


def q_model_comparison(spark, d, measure=MEASURE):
    """Persistence, mean-of-3 and train-mean forecasts on identical rows,
    with each model's MAE change relative to persistence."""
    p = P.tag_split(_panel(spark, d, measure))
    train_mean = p.filter(F.col("split") == "train").agg(F.avg(measure)).scalar()  # a subquery of one value
    t = p.filter(F.col("split") == "test").withColumn("overall_mean", train_mean)
    models = {"persistence": f"lag1_{measure}", "mean3": f"rolling3_{measure}", "overall_mean": "overall_mean"}
    m = E.long_model_metrics(t, measure, models, baseline=f"lag1_{measure}")
    return m.select("model", "n", *_metric_cols(),
                    _r(E.improvement_pct("base_mae", "mae")).alias("mae_improvement_pct"))


def _pair_metrics(spark, d, measure: str = MEASURE) -> DataFrame:
    t = _test_rows(spark, d, measure)
    return t.agg(
        *[x.alias(f"model_{n}") for x, n in zip(E.metric_columns(measure, f"rolling3_{measure}")[1:],
                                                 ["mae", "rmse", "r2", "wape_pct"])],
        *[x.alias(f"base_{n}") for x, n in zip(E.metric_columns(measure, f"lag1_{measure}")[1:],
                                                ["mae", "rmse", "r2", "wape_pct"])],
    )


def q_baseline_vs_mean(spark, d):
    m = _pair_metrics(spark, d)
    return m.select(_r("model_mae").alias("mean3_mae"), _r("base_mae").alias("persistence_mae"),
                    _r(E.improvement_pct("base_mae", "model_mae")).alias("mae_improvement_pct"))


def q_acceptance(spark, d, measure=MEASURE):
    m = _pair_metrics(spark, d, measure)
    return m.select(
        (F.col("model_mae") < F.col("base_mae")).alias("mae_better"),
        (F.col("model_rmse") < F.col("base_rmse")).alias("rmse_better"),
        (F.col("model_wape_pct") < F.col("base_wape_pct")).alias("wape_better"),
        E.acceptance("model_mae", "model_rmse", "model_wape_pct", "base_mae", "base_rmse",
                     "base_wape_pct").alias("accepted"),
    )


def q_one_hot(spark, d):
    from tessera.operators.models import one_hot_slots

    p = P.tag_split(_panel(spark, d))
    return one_hot_slots(p.filter(F.col("split") == "train"), p, "geo")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}


# --------------------------------------------------------------------------
# Report tables (V16, V17) and recommendation rules
# --------------------------------------------------------------------------

def q_slice_contract(spark, d):
    """Every named slice with its row count, from ONE pass (each row is
    tagged with the slices it belongs to; no per-slice scans)."""
    c = _clean(spark, d)
    dom = ~F.col("geo").isin(K.GEO_EXCLUDED)
    tags = []
    for name, grain, geos, sexes, bands in K.SLICES:
        cond = (F.col("grain") == grain) & F.col("sex").isin(sexes) & F.col("band").isin(bands)
        cond = cond & (F.col("geo").isin(geos) if geos else dom)
        tags.append(F.when(cond, F.lit(name)))
    t = c.select(F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("slice"))
    return t.groupBy("slice").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


def q_quality_outcomes(spark, d):
    """Audit counters unpivoted to (test, result, passed)."""
    r = Q.rule_audit(_clean(spark, d))
    cols = r.columns
    long = r.unpivot([], cols, "test", "result")
    return long.select("test", F.col("result").cast("bigint").alias("result"),
                       (F.col("result") == 0).alias("passed"))


def q_suppression_bounds(spark, d):
    """Lower / midpoint / upper scenario sums treating each suppressed
    cell as 1, 5 or 9, per geography for the monthly panel measure."""
    c = _clean(spark, d)
    p = S.require_levels(S.in_domain(S.grain_slice(c, K.GRAIN_MONTH, sex=K.SEX_ALL, band=K.BAND_ALL)), MEASURE, ["geo"])
    sup = F.col(f"{MEASURE}_suppressed")
    v = F.col(MEASURE)
    return p.groupBy("geo").agg(
        F.sum(F.coalesce(v, F.when(sup, F.lit(float(K.SUPPRESS_LO))))).alias("lower"),
        F.sum(F.coalesce(v, F.when(sup, F.lit(K.MIDPOINT)))).alias("mid"),
        F.sum(F.coalesce(v, F.when(sup, F.lit(float(K.SUPPRESS_HI))))).alias("upper"),
        F.sum(sup.cast("int")).cast("bigint").alias("suppressed_cells"),
    )


def q_wape_monitor(spark, d, measure=MEASURE):
    """Rolling two-month WAPE of the mean-of-3 forecast against
    persistence; suspend when it exceeds the baseline by 5 points.
    Monthly error sums first (one row per month), then the window runs over
    that bounded monthly table."""
    from pyspark.sql import Window

    t = _test_rows(spark, d, measure)
    m = t.groupBy("start_date").agg(
        F.sum(F.abs(F.col(measure) - F.col("prediction"))).alias("err"),
        F.sum(F.abs(F.col(measure) - X.clip_prediction(F.col(f"lag1_{measure}")))).alias("base_err"),
        F.sum(measure).alias("actual"),
    )
    w = Window.orderBy("start_date").rowsBetween(-1, 0)  # one row per month
    r = m.select(
        "start_date",
        F.try_divide(F.lit(100.0) * F.sum("err").over(w), F.sum("actual").over(w)).alias("wape_2m"),
        F.try_divide(F.lit(100.0) * F.sum("base_err").over(w), F.sum("actual").over(w)).alias("base_wape_2m"),
    )
    return r.select(_iso("start_date"), _r("wape_2m").alias("wape_2m"), _r("base_wape_2m").alias("base_wape_2m"),
                    (F.col("wape_2m") > F.col("base_wape_2m") + 5).alias("suspend"))


def q_conformal_band(spark, d, measure=MEASURE):
    """Blocked conformal half-width = 90th percentile of the absolute
    mean-of-3 residual on the validation block; coverage on the test rows."""
    p = P.tag_three_way(_panel(spark, d, measure))
    resid = F.abs(F.col(measure) - X.clip_prediction(F.col(f"rolling3_{measure}")))
    half = D.quantiles(p.filter(F.col("split") == "validation").withColumn("resid", resid), "resid", (0.9,)).scalar()  # a subquery of one value
    t = p.filter(F.col("split") == "test").withColumn("half_width", half)
    return t.groupBy("half_width").agg(
        F.count(F.lit(1)).cast("bigint").alias("test_rows"),
        F.avg((resid <= F.col("half_width")).cast("double")).alias("coverage"),
    ).select(_r("half_width").alias("half_width"), "test_rows", _r("coverage").alias("coverage"))


def q_national_series(spark, d):
    """V3: the national monthly series including the partial last month,
    with the peak among complete months flagged (the peak is one row, joined back on the slice keys)."""
    n = _national(_clean(spark, d), K.GRAIN_MONTH)
    peak = S.complete_periods(n).groupBy("grain", "geo", "sex", "band").agg(
        D.arg_max(F.col("a"), F.col("start_date")).alias("__peak"))
    j = n.join(bounded_broadcast(peak, D.MAX_SLICES), ["grain", "geo", "sex", "band"], "left")
    return j.select(_iso("start_date"), "a", "total", "is_partial_period",
                    F.coalesce(F.col("start_date") == F.col("__peak"), F.lit(False)).alias("is_peak"))


def q_input_checksum(spark, d):
    """Order-free fingerprint of the text extract, per grain."""
    return content_fingerprint(load_text(spark, d), ["Group"])


def q_gap_audit(spark, d):
    """Months missing inside a geography's series; row lags would cross them."""
    g = P.gap_audit(_clean(spark, d))
    return g.select("geo", _iso("start_date"), _iso("prev"))


def q_gap_audit_observed(spark, d):
    """Months missing from the series of published counts; suppression leaves such gaps."""
    g = P.series_gaps(P.observed_series(_clean(spark, d), MEASURE))
    return g.select("geo", _iso("start_date"), _iso("prev"), "missing_months")


def q_calendar_lags(spark, d):
    """Lags by row and by calendar on the published counts, and whether a row lag crosses a gap."""
    c = P.calendar_lags(P.observed_series(_clean(spark, d), MEASURE), MEASURE)
    crosses = F.lit(False)
    for k in (1, 2, 3):
        crosses = crosses | (F.col(f"row_lag{k}").isNotNull() & ~F.col(f"row_lag{k}").eqNullSafe(F.col(f"cal_lag{k}")))
    return c.withColumn("crosses_gap", crosses).select("geo", _iso("start_date"), MEASURE, *[f"{p}_lag{k}" for p in ("row", "cal") for k in (1, 2, 3)],
                                                       _r("cal_rolling3").alias("cal_rolling3"), "crosses_gap")


INTERVAL_MEASURES = ["a", "total"]


def _suppressed_bounds(spark, d) -> DataFrame:
    cells = once(spark, d, "intervals", lambda: IV.tighten(_clean(spark, d), INTERVAL_MEASURES))
    return IV.suppressed_bounds(cells, INTERVAL_MEASURES)


def q_suppression_intervals(spark, d):
    """Every suppressed cell of two measures with the narrowest bounds that all sums prove."""
    return _suppressed_bounds(spark, d).withColumn("start_date", F.col("start_date").cast("string"))


def q_interval_summary(spark, d):
    """Per measure and grain the suppressed cells, those whose value the sums give away, and the mean width of the rest."""
    rows = _suppressed_bounds(spark, d)
    width = F.col("upper") - F.col("lower")
    return rows.groupBy("measure", "grain").agg(
        F.count(F.lit(1)).alias("suppressed"), F.count_if(width == 0).alias("given_away"),
        F.count_if(width < K.SUPPRESS_HI - K.SUPPRESS_LO).alias("narrowed"), _r(F.avg(width)).alias("mean_width"))


def q_reconcile_bounds(spark, d):
    """A16 for every measure and every family of sums, suppressed cells as intervals."""
    return IV.reconcile_bounds(_clean(spark, d))


def q_price_quantiles(spark, d):
    """G1 over the fact rows: exact quantiles of the price per return flag and line status."""
    rows = read_table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    q = D.quantiles(rows, "l_extendedprice", probs, ["l_returnflag", "l_linestatus"])
    return q.select("l_returnflag", "l_linestatus", *[_r(c).alias(c) for c in q.columns[2:]])


def q_fact_rank_correlation(spark, d):
    """G12 over the fact rows: rank correlations of quantity, price and discount."""
    rows = read_table(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount")
    return D.spearman_long(rows, ["l_quantity", "l_extendedprice", "l_discount"]).select("x", "y", _r("rho").alias("rho"))


def q_conformal_blocks(spark, d):
    """R4 in blocks: each validation block's half-width with the finite-sample rank, and how many test rows it covers."""
    folds = P.fold_rows(_panel(spark, d)).filter(F.col("role") == "validation")
    widths = E.conformal_half_widths(_with_residual(folds), "resid", "fold")
    test = _with_residual(P.tag_split(_panel(spark, d)).filter(F.col("split") == "test")).select("resid")
    both = test.join(bounded_broadcast(widths, len(K.FOLDS)), F.lit(True))  # three blocks
    covered = both.groupBy("fold", "n", "rank", "half_width").agg(
        F.count(F.lit(1)).alias("test_rows"), _r(F.avg((F.col("resid") <= F.col("half_width")).cast("double"))).alias("coverage"))
    return covered.withColumn("half_width", _r("half_width"))


def _with_residual(rows: DataFrame) -> DataFrame:
    return rows.withColumn("resid", F.abs(F.col(MEASURE) - X.clip_prediction(F.col(f"rolling3_{MEASURE}"))))


def q_monthly_errors(spark, d):
    """Errors of the mean-of-3 forecast per test month, and the worst geography."""
    m = E.monthly_errors(_test_rows(spark, d), MEASURE, "prediction")
    return m.select(_iso("start_date"), "n", *[_r(c).alias(c) for c in ("mae", "rmse", "wape_pct")], "worst_geo", _r("worst_error").alias("worst_error"))


def q_rule_audit_in_flight(spark, d):
    """The counters taken while the clean table was written."""
    counts = {k: v for k, v in write_audit(spark, d).items() if k != "rows"}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


def q_wape_monitor_stream(spark, d):
    """R3 as a stream: the test scores arrive in several files, the monitor is read after the last."""
    from tessera.streaming.monitor import monitor_scores, read_cells, rolling_wape

    path = scratch_path(spark, f"scores-{uuid.uuid4().hex[:12]}")
    scores = _test_rows(spark, d).select("geo", "start_date", F.lit(1).cast("long").alias("version"), F.col(MEASURE).alias("actual"), "prediction",
                                         F.col(f"lag1_{MEASURE}").alias("baseline"))
    scores.repartition(4, "geo").write.parquet(f"{path}/in")
    monitor_scores(spark, f"{path}/in", f"{path}/out")
    r = rolling_wape(read_cells(spark, f"{path}/out"))
    return r.select(_iso("start_date"), _r("wape_2m").alias("wape_2m"), _r("base_wape_2m").alias("base_wape_2m"), "suspend")


def q_snapshot_diff(spark, d):
    """The cells that differ between the extract and a corrected one: national yearly totals of a band edited, a geography's second
    months withdrawn, and its total republished under a new name."""
    from tessera.sources.snapshot import cell_changes

    old = load_text(spark, d)
    edited = (F.col("Group") == K.GRAIN_YEAR) & (F.col("Geo") == K.GEO_ALL) & (F.col("Band") == K.EXCLUSIVE_BAND_LABELS[2])
    withdrawn = (F.col("Geo") == K.NESTED_PARENT) & F.col("Month").eqNullSafe("2")
    total = F.when(edited, F.concat(F.lit("1"), F.col("Total Count"))).otherwise(F.col("Total Count"))
    renamed = old.where((F.col("Geo") == K.NESTED_PARENT) & (F.col("Group") == K.GRAIN_TOTAL)).withColumn("Geo", F.lit("NEW"))
    new = old.where(~withdrawn).withColumn("Total Count", total).unionByName(renamed)
    return cell_changes(old, new, ["Group", "Geo"], K.SOURCE_KEY_HEADER)


SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]


def q_distinct_sketches(spark, d):
    """A3 over batches: distinct values of four fact columns from sketches per ship year, beside the exact counts; the estimates must lie within
    three standard errors."""
    from tessera.operators.sketches import BOUND, batch_sketches, merged_counts

    rows = read_table(spark, d, "lineitem", *SKETCHED)
    sketches = write_scratch(batch_sketches(rows.withColumn("batch", F.year("l_shipdate")), ["batch"], SKETCHED), "sketches")
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], SKETCHED, "field", "exact")
    near = (F.abs(F.col("estimate") - F.col("exact")) <= F.lit(BOUND) * F.col("exact")).alias("within_bound")
    return merged_counts(sketches).join(exact, "field").select("field", "batches", "rows", "exact", near)


def q_headline_values(spark, d):
    """Named single values of the national slices: share of the peak month, the value of a fixed month, the largest
    band, totals by sex, their ratio, and the band with the largest ratio."""
    nm = S.require_levels(S.complete_periods(_national(_clean(spark, d), K.GRAIN_MONTH)))
    month = nm.agg(
        _r(pct(F.max("a"), F.sum("a"))).alias("peak_month_share_pct"),
        F.max(F.when(F.col("start_date") == F.lit(K.NAMED_MONTH).cast("date"), F.col("a"))).alias("named_month_a"))
    bands = S.require_levels(_national_bands(spark, d)).agg(F.max("a").alias("largest_band_a"), _r(pct(F.max("a"), F.sum("a"))).alias("largest_band_pct"))
    p0, p1 = (f"a_{x}" for x in K.SEX_PARTS)
    pairs = _sex_band_pivot(spark, d).withColumn("ratio", F.try_divide(F.col(p1), F.col(p0))).withColumn("ordinal", D.band_ordinal())
    sexes = pairs.agg(
        F.sum(p0).alias("sex0_a"), F.sum(p1).alias("sex1_a"), _r(F.try_divide(F.sum(p1), F.sum(p0))).alias("ratio_of_sums"),
        D.arg_max(F.col("ratio"), F.col("ordinal")).alias("ordinal")).withColumn(
        "largest_ratio_band", F.element_at(F.array(*[F.lit(b) for b in K.EXCLUSIVE_BAND_LABELS]), F.col("ordinal") + 1)).drop("ordinal")
    names = [*month.columns, *bands.columns, *sexes.columns]
    return _one_row([month, bands, sexes], names)


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """One-row frames side by side: padded, united, and the one non-null value of each column taken."""
    types = {f.name: f.dataType for p in parts for f in p.schema.fields}
    padded = [p.select(*[(F.col(n) if n in p.columns else F.lit(None)).cast(types[n]).alias(n) for n in names]) for p in parts]
    out = padded[0]
    for p in padded[1:]:
        out = out.unionByName(p)
    return out.agg(*[F.max(n).alias(n) for n in names])


def q_findings(spark, d):
    """The findings table, one row per finding: its name, the value and what it is about."""
    def row(df, name, value, about):
        return df.select(F.lit(name).alias("finding"), F.col(value).cast("double").alias("value"), F.col(about).cast("string").alias("about"))

    everyone = lambda df: df.withColumn("everyone", F.lit("national"))
    extremes, shares = q_extremes(spark, d), q_geo_share_stats(spark, d)
    parts = [
        row(everyone(q_national_totals(spark, d)), "national share pct", "a_share_pct", "everyone"),
        row(extremes, "peak month", "peak_a", "peak_month"), row(extremes, "lowest month", "low_a", "low_month"),
        row(shares, "highest share pct", "max_share", "max_geo"), row(shares, "lowest share pct", "min_share", "min_geo"),
        row(everyone(q_senior_share(spark, d)), "senior share pct", "senior_share_pct", "everyone"),
        row(q_decline_from_peak(spark, d), "decline from peak pct", "decline_pct", "last_month"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _on_total(fn):
    return lambda spark, d: fn(spark, d, "total")


#: FIXTURES 3: the panel keys on the unsuppressed-most measure as well.
TOTAL_KEYS = ("lag_panel", "forecast_errors", "baseline_metrics", "model_comparison", "acceptance", "wape_monitor", "conformal_band")

QUERIES.update({
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn) and name[2:] not in QUERIES
})
QUERIES.update({f"{name}_total": _on_total(QUERIES[name]) for name in TOTAL_KEYS})
