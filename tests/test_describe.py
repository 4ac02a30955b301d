import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import describe as D
from tessera.operators import panel as P
from tessera.functions import features as X


def test_quantiles_linear(spark):
    vals = [5.0, 1.0, 9.0, 3.0, 7.0, 11.0]
    df = spark.createDataFrame([(v, "s") for v in vals], "v double, s string")
    q = D.iqr_bounds(df, "v", ["s"]).first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert q.q1 == pytest.approx(q1) and q.q3 == pytest.approx(q3)
    assert q.fence == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_arg_max_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", None), ("d", 1.0)], "k string, v double")
    r = df.agg(D.arg_max(F.col("v"), F.col("k")).alias("mx"), D.arg_min(F.col("v"), F.col("k")).alias("mn")).first()
    assert r.mx == "a" and r.mn == "d"


def test_min_count_sum(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("g", 2.0), ("h", 1.0), ("h", 2.0), ("h", 3.0)],
                               "geo string, v double")
    out = {r.geo: r.s for r in D.min_count_sum(df, "v", ["geo"], 3, "s").collect()}
    assert out == {"g": None, "h": 6.0}


def test_pivot_duplicate_raises(spark):
    df = spark.createDataFrame([("x", "F", 1.0), ("x", "F", 2.0), ("x", "O", 3.0)], "band string, sex string, a double")
    with pytest.raises(Exception):
        D.guarded_pivot(df, ["band"], "sex", ["F", "O"], "a").collect()
    ok = D.guarded_pivot(df.limit(0).union(spark.createDataFrame([("x", "F", 1.0)], df.schema)),
                         ["band"], "sex", ["F", "O"], "a").first()
    assert ok.F == 1.0 and ok.O is None


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0, "s"), (18.0, "s"), (9.0, "s")], "v double, s string")
    h = {r.bin: r.n for r in D.histogram(df, "v", 18, ["s"]).collect()}
    assert len(h) == 18 and h[17] == 1 and h[0] == 1 and h[9] == 1 and sum(h.values()) == 3


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"x": rng.integers(0, 5, 40).astype(float), "y": rng.normal(size=40),
                        "z": rng.integers(0, 3, 40).astype(float)})
    pdf.loc[3, "y"] = np.nan
    pdf.loc[7, "z"] = np.nan
    sdf = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double, z double")
    got = {(r.x, r.y): r.rho for r in D.spearman_long(sdf, ["x", "y", "z"]).collect()}
    want = pdf.corr(method="spearman")
    for a in "xyz":
        for b in "xyz":
            assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-12)


def _clean_series(spark, months_by_geo):
    rows = []
    for geo, months in months_by_geo.items():
        for m, v in months:
            rows.append(("By Month", geo, "All", "All Bands", pd.Timestamp(m).date(), int(pd.Timestamp(m).month),
                         float(v), 100.0, 10.0, False))
    return spark.createDataFrame(
        rows, "grain string, geo string, sex string, band string, start_date date, month int, a double, "
              "total double, b double, is_partial_period boolean")


def test_lag_panel_windows(spark):
    df = _clean_series(spark, {
        "one": [("2000-01-01", 1)],
        "three": [("2000-01-01", 1), ("2000-02-01", 2), ("2000-03-01", 3)],
        "four": [("2000-01-01", 1), ("2000-02-01", 2), ("2000-03-01", 3), ("2000-04-01", 4)],
        "gap": [("2000-01-01", 1), ("2000-02-01", 2), ("2000-04-01", 4), ("2000-05-01", 5)],
    })
    p = {(r.geo, str(r.start_date)): r for r in P.monthly_panel(df, "a").collect()}
    assert p[("one", "2000-01-01")].rolling3_a is None
    assert p[("three", "2000-03-01")].rolling3_a is None
    assert p[("four", "2000-04-01")].rolling3_a == 2.0
    assert p[("four", "2000-04-01")].lag1_a == 3.0  # never the current row
    # row lag crosses the missing month (documented); the gap audit reports it
    assert p[("gap", "2000-04-01")].lag1_a == 2.0
    gaps = P.gap_audit(df.withColumn("is_partial_period", F.lit(False))).collect()
    assert [(g.geo, str(g.start_date)) for g in gaps] == [("gap", "2000-04-01")]
    assert P.lag_panel(df, "a").count() == 1 + 1  # four@Apr and gap@May


def test_midpoint_only_for_lags(spark):
    df = _clean_series(spark, {"g": [("2000-01-01", 1), ("2000-02-01", 2), ("2000-03-01", 3),
                                     ("2000-04-01", 4), ("2000-05-01", 5)]})
    df = df.withColumn("a", F.when(F.col("start_date") == "2000-02-01", None).otherwise(F.col("a")))
    p = {str(r.start_date): r for r in P.monthly_panel(df, "a").collect()}
    assert p["2000-02-01"].a is None
    assert p["2000-03-01"].lag1_a == 5.0


def test_clip_prediction(spark):
    df = spark.createDataFrame([(-2.0,), (None,), (3.0,)], "p double")
    assert [r.c for r in df.select(X.clip_prediction("p").alias("c")).collect()] == [0.0, None, 3.0]
    r = spark.range(1).select(X.residual_reconstruct(F.lit(9.0), F.lit(0.0)).alias("v")).first()
    assert r.v == pytest.approx(9.0)
    assert math.isclose(spark.range(1).select(X.month_sin(F.lit(3))).first()[0], 1.0)


def test_single_level_guard(spark):
    from tessera.operators.slices import assert_single_level

    ok = spark.createDataFrame([("By Total", "G", "All", "All Bands")], "grain string, geo string, sex string, band string")
    assert_single_level(ok)
    bad = ok.union(spark.createDataFrame([("By Total", "G", "F", "All Bands")], ok.schema))
    with pytest.raises(ValueError, match="sex"):
        assert_single_level(bad)


def test_profile_rowwise_sum_and_min_count(spark):
    """Yearly row-wise sum skips a null year; the senior sum needs all 3 bands."""
    from tessera.operators.profile import geo_profile

    def row(grain, year, sex, band, a, total=100.0, b=10.0, ov=5.0, c=3.0):
        return (grain, year, "G1", sex, band, a, total, b, ov, c)

    rows = [
        row("By Total", None, "All", "All Bands", 40.0),
        row("By Total", None, "F", "All Bands", 10.0),
        row("By Total", None, "O", "All Bands", 30.0),
        row("By Total", None, "All", "35-39", 5.0),
        row("By Total", None, "All", "40-44", None),
        row("By Total", None, "All", "45-50", 7.0),
        row("By Year", 1995, "All", "All Bands", None),
        row("By Year", 1996, "All", "All Bands", 6.0),
        row("By Year", 1997, "All", "All Bands", 2.0),
    ]
    df = spark.createDataFrame(rows, "grain string, year int, geo string, sex string, band string, a double, "
                                     "total double, b double, overlap double, c double")
    p = geo_profile(df).first()
    assert p.a_pct_total == 40.0 and p.f_a_pct == 25.0
    assert p.senior_a_pct is None  # one of three senior bands missing
    assert p.year_mid_pct == pytest.approx(100 * 6 / 8)  # null year counts as 0
