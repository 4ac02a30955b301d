"""Bounds of suppressed cells: true counts stay inside, sums give away what they must, planted contradictions are found."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.operators import intervals as IV

SF = "/root/testdata/sf0.001"
SCHEMA = "grain string, start_date date, geo string, sex string, band string, year int, a double, a_suppressed boolean"


def small_cube(spark, counts, geos=("X", "Y")):
    """A cube with one year of two months, two sexes and all exclusive bands; ``counts``(month, geo, sex, band) -> true count.
    Returns the published table and the true values by cell."""
    import datetime

    leaf = {(m, g, s, b): counts(m, g, s, b) for m in (1, 2) for g in geos for s in K.SEX_PARTS for b in K.EXCLUSIVE_BAND_LABELS}
    true = {}
    periods = {(K.GRAIN_MONTH, 1): [1], (K.GRAIN_MONTH, 2): [2], (K.GRAIN_YEAR, None): [1, 2], (K.GRAIN_TOTAL, None): [1, 2]}
    for (grain, month), months in periods.items():
        for g, s, b in itertools.product((*geos, K.GEO_ALL), K.SEXES, (K.BAND_ALL, *K.EXCLUSIVE_BAND_LABELS)):
            value = sum(v for (m, gg, ss, bb), v in leaf.items()
                        if m in months and g in (gg, K.GEO_ALL) and s in (ss, K.SEX_ALL) and b in (bb, K.BAND_ALL))
            start = datetime.date(1998, month or 1, 1)
            true[grain, start, g, s, b] = (float(value), 1998 if grain != K.GRAIN_TOTAL else None)
    rows = []
    for (grain, start, g, s, b), (v, year) in true.items():
        hidden = g != K.GEO_ALL and K.SUPPRESS_LO <= v <= K.SUPPRESS_HI
        rows.append((grain, start, g, s, b, year, None if hidden else v, hidden))
    return spark.createDataFrame(rows, SCHEMA), {k: v for k, (v, _) in true.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_true_counts_stay_inside_and_no_sum_can_narrow_further(spark, seed):
    rng = random.Random(seed)
    cube, true = small_cube(spark, lambda *_: rng.choice((0, 1, 2, 5, 8, 9, 30)))
    cells = IV.tighten(cube, ["a"]).persist()
    for r in cells.collect():
        cell = (r["grain"], r["start_date"], r["geo"], r["sex"], r["band"])
        assert r["lower_a"] <= true[cell] <= r["upper_a"]
        assert r["a_suppressed"] or r["lower_a"] == r["upper_a"]
    assert cells.where("a_suppressed AND upper_a - lower_a < 8").count() > 20  # something was learnt
    for family in IV.families().values():  # a fixed point: each sum by itself changes nothing
        again = IV.narrow(cells, family, ["a"])
        assert again.exceptAll(cells).count() == 0
    cells.unpersist()


def test_a_single_hidden_child_is_given_away(spark):
    cube, true = small_cube(spark, lambda m, g, s, b: 3 if (m, g, s, b) == (1, "X", "F", "5-9") else 20)
    rows = {tuple(r[:5]): (r["lower"], r["upper"]) for r in IV.suppressed_bounds(IV.tighten(cube, ["a"]), ["a"]).collect()}
    assert len(rows) == 1 and set(rows.values()) == {(3.0, 3.0)}


def test_two_hidden_children_share_their_rest(spark):
    """2 and 9 hidden in one sum of which 11 is left: each lies in [2, 9]."""
    planted = {(1, "X", "F", "5-9"): 2, (1, "X", "F", "2-4"): 9, (1, "Y", "F", "5-9"): 9, (1, "Y", "F", "2-4"): 2,
               (1, "X", "O", "5-9"): 9, (1, "X", "O", "2-4"): 2, (1, "Y", "O", "5-9"): 2, (1, "Y", "O", "2-4"): 9}
    cube, _ = small_cube(spark, lambda m, g, s, b: planted.get((m, g, s, b), 40))
    rows = IV.suppressed_bounds(IV.tighten(cube, ["a"], which=["bands"]), ["a"]).collect()
    assert len(rows) == 8 and {(r["lower"], r["upper"]) for r in rows} == {(2.0, 9.0)}


def test_missing_without_suppression_is_open(spark):
    cube, _ = small_cube(spark, lambda *_: 20)
    lost = (F.col("geo") == "X") & (F.col("band") == "5-9") & (F.col("sex") == "F") & (F.col("grain") == K.GRAIN_MONTH) & (F.month("start_date") == 1)
    broken = cube.withColumn("a", F.when(~lost, F.col("a")))
    first = IV.bounds(broken, ["a"]).where(lost).first()
    assert (first["lower_a"], first["upper_a"]) == (0.0, IV.OPEN)
    found = IV.tighten(broken, ["a"]).where(lost).first()
    assert (found["lower_a"], found["upper_a"]) == (20.0, 20.0)


def test_contradictions_are_counted(spark):
    cube, _ = small_cube(spark, lambda *_: 20)
    wrong = (F.col("grain") == K.GRAIN_MONTH) & (F.col("geo") == "Y") & (F.col("sex") == "F") & (F.col("band") == "5-9") & (F.month("start_date") == 2)
    counts = {r["family"]: (r["exact"], r["within"], r["violated"]) for r in IV.reconcile_bounds(cube.withColumn("a", F.when(wrong, 21.0).otherwise(F.col("a"))), ["a"]).collect()}
    assert {f: c[2] for f, c in counts.items()} == {"bands": 1, "sexes": 1, "geos": 1, "months": 1, "years": 0}
    assert sum(c[1] for c in counts.values()) == 0
    assert IV.reconcile_bounds(cube.limit(0), ["a"]).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_true_counts_of_the_cube_stay_inside(spark):
    from tessera.sources.cube import cube_cells
    from tessera.sources.store import load_clean, materialize

    cells = IV.tighten(load_clean(spark, SF), ["a"])
    true = cube_cells(spark.read.parquet(materialize(spark, SF)["fine"])).select("grain", F.col("pkey").alias("start_date"), "geo", "sex", "band", F.col("a").alias("truth"))
    joined = cells.where("grain != 'By Total'").join(true, IV.CELL, "left").withColumn("truth", F.coalesce("truth", F.lit(0)))
    assert joined.where("truth < lower_a OR truth > upper_a").count() == 0
    assert joined.where("a_suppressed").count() > 1000
