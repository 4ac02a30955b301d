"""Quantiles by narrowing and distributed ranks against numpy; calendar lags on a panel with planted gaps."""

import datetime
import random

import numpy as np
import pytest

from tessera.operators import describe as D
from tessera.operators import panel as P
from tessera.operators import ranks as R


def test_quantiles_of_awkward_columns(spark):
    rng = np.random.default_rng(4)
    columns = {
        "uniform": rng.uniform(-5, 5, 500), "normal": rng.normal(0, 1e-9, 301), "powers": 2.0 ** np.arange(-300, 300), "equal": np.full(77, 3.25),
        "two": np.array([1.0, 2.0]), "one": np.array([-7.5]), "ties": rng.integers(0, 4, 400).astype(float), "wide": np.array([-1e308, -1.0, 0.0, 1e-300, 5.0, 1e308]),
        "close": 1.0 + np.arange(2000) * 2.0 ** -52, "heavy": np.concatenate((np.zeros(900), rng.exponential(1e6, 100)))}
    rows = [(name, float(v)) for name, values in columns.items() for v in values] + [("uniform", None), ("empty", None), (None, 4.0), (None, 6.0)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "name string, v double").repartition(6)
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {r["name"]: list(r)[1:] for r in R.exact_quantiles(df, "v", probs, ["name"], bins=16).collect()}
    assert got["empty"] == [None] * 6 and got[None] == pytest.approx([4.0, 4.2, 4.5, 5.0, 5.8, 6.0])
    for name, values in columns.items():
        v = np.sort(values)
        h = [(len(v) - 1) * p for p in probs]
        want = [v[int(x)] + (v[int(np.ceil(x))] - v[int(x)]) * (x - int(x)) for x in h]
        assert got[name] == pytest.approx(want, rel=1e-12, abs=1e-300), name


def test_quantiles_without_slices(spark):
    df = spark.createDataFrame([(float(k),) for k in range(11)] + [(None,)], "v double")
    assert list(R.exact_quantiles(df, "v").first()) == [2.5, 7.5]
    assert list(R.exact_quantiles(df.where("v IS NULL"), "v", (0.5,)).first()) == [None]
    with pytest.raises(ValueError):
        R.exact_quantiles(df, "v", (1.5,))


def test_no_task_holds_a_slice(spark):
    """What a pass gathers is one row a bin: the plan of a pass aggregates before its only exchange of values."""
    df = spark.range(5000).selectExpr("id % 1 AS s", "CAST(id * 7919 % 5003 AS DOUBLE) AS v")
    got = R.exact_quantiles(df, "v", (0.5,), ["s"], bins=8).first()["q50"]
    assert got == np.median([k * 7919 % 5003 for k in range(5000)])


def average_ranks(values):
    order = sorted(values)
    return {v: order.index(v) + (order.count(v) + 1) / 2 for v in set(values)}


def test_average_ranks_by_slice(spark):
    rng = random.Random(2)
    slices = {s: [float(rng.randrange(12)) for _ in range(rng.randrange(1, 60))] for s in ("a", "b", None)}
    rows = [(s, v, 1) for s, values in slices.items() for v in values] + [("a", None, 5)]
    got = R.average_ranks(spark.createDataFrame(rows, "s string, v double, n int").repartition(5), "v", ["s"]).collect()
    for s, values in slices.items():
        want = average_ranks(values)
        assert {r["v"]: r["rank"] for r in got if r["s"] == s} == want
        assert {r["v"]: r["n"] for r in got if r["s"] == s} == {v: values.count(v) for v in want}


def test_rank_correlations_skip_missing_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, 200).astype(float)
    y = x + rng.normal(0, 5, 200).round()
    rows = [(float(a), None if k % 9 == 0 else float(b), 1.0) for k, (a, b) in enumerate(zip(x, y))]
    got = {(r["x"], r["y"]): r["rho"] for r in D.spearman_long(spark.createDataFrame(rows, "x double, y double, c double"), ["x", "y", "c"]).collect()}
    kept = [(a, b) for a, b, _ in rows if b is not None]
    ranks = [average_ranks([p[k] for p in kept]) for k in (0, 1)]
    want = np.corrcoef([ranks[0][a] for a, _ in kept], [ranks[1][b] for _, b in kept])[0, 1]
    assert got["x", "y"] == got["y", "x"] == pytest.approx(want)
    assert got["x", "x"] == pytest.approx(1) and got["x", "c"] is None and len(got) == 9


def test_calendar_lags_do_not_cross_gaps(spark):
    months = [(g, datetime.date(1998 + m // 12, m % 12 + 1, 1), float(100 * k + m)) for k, g in enumerate("ab") for m in range(16)]
    gaps = {("a", 3), ("a", 4), ("b", 12)}
    rows = [(g, d, v) for g, d, v in months if (g, (d.year - 1998) * 12 + d.month - 1) not in gaps]
    df = spark.createDataFrame(rows, "geo string, start_date date, a double")
    got = {(r["geo"], r["start_date"]): r for r in P.calendar_lags(df, "a").collect()}
    value = {(g, d): v for g, d, v in rows}
    for (g, d), r in got.items():
        back = [datetime.date(d.year + (d.month - 1 - k) // 12, (d.month - 1 - k) % 12 + 1, 1) for k in (1, 2, 3)]
        lags = [value.get((g, b)) for b in back]
        assert [r[f"cal_lag{k}"] for k in (1, 2, 3)] == lags
        assert r["cal_rolling3"] == (pytest.approx(sum(lags) / 3) if None not in lags else None)
    after = got["a", datetime.date(1998, 6, 1)]
    assert after["row_lag1"] == 2.0 and after["cal_lag1"] is None and after["cal_lag3"] == 2.0
    found = {(r["geo"], str(r["start_date"]), str(r["prev"]), r["missing_months"]) for r in P.series_gaps(df).collect()}
    assert found == {("a", "1998-06-01", "1998-03-01", 2), ("b", "1999-02-01", "1998-12-01", 1)}


def test_conformal_rank_of_small_blocks(spark):
    from tessera.operators.evaluate import conformal_half_widths, monthly_errors

    rng = random.Random(4)
    blocks = {"a": [rng.uniform(-9, 9) for _ in range(40)], "b": [3.0] * 12, "c": [1.0] * 5}
    df = spark.createDataFrame([(b, v) for b, vs in blocks.items() for v in vs] + [("a", None)], "block string, e double")
    got = {r["block"]: tuple(r)[1:] for r in conformal_half_widths(df, "e", "block").collect()}
    assert got["a"] == (40, 37, sorted(map(abs, blocks["a"]))[36]) and got["b"] == (12, 12, 3.0) and got["c"] == (5, 6, None)
    rows = [("x", datetime.date(2000, 1, 1), 5.0, 2.0), ("y", datetime.date(2000, 1, 1), 5.0, 8.0), ("z", datetime.date(2000, 1, 1), 5.0, 5.0)]
    m = monthly_errors(spark.createDataFrame(rows, "geo string, start_date date, a double, p double"), "a", "p").first()
    assert (m["worst_geo"], m["worst_error"], m["mae"], m["n"]) == ("x", 3.0, 2.0, 3)
