"""Loss histories, the stopping rule and the residual trees; rules are recomputed by DuckDB over the written tables."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.operators import models as M

SF = "/root/testdata/sf0.01"


def stop_by_hand(valid, patience, min_delta):
    best, at = float("inf"), 0
    for i, v in enumerate(valid, 1):
        if v < best - min_delta:
            best, at = v, i
        elif i - at >= patience:
            return at, best, i, True
    return at, best, len(valid), False


def history(spark, curves):
    rows = [(m, 0, 9.0, 9.0) for m in curves] + [(m, i, 1.0 / i, float(v)) for m, c in curves.items() for i, v in enumerate(c, 1)]
    return spark.createDataFrame(rows, M.HISTORY).repartition(7)


def points(df, **kw):
    return {r["model"]: (r["best_iteration"], r["best_valid"], r["stop_iteration"], r["stopped_early"]) for r in M.early_stop_points(df, **kw).collect()}


def test_published_stop_point(spark):
    """Best round 4 with a loss of 0.07925 and patience 20 end the fit at round 24; the unregularized fit has its lowest loss first and a gap of 0.47881."""
    regular = [0.09, 0.085, 0.08, 0.07925, *(0.0795 + 0.0001 * k for k in range(246))]
    free = [0.1 + (0.49378 - 0.1) * k / 159 for k in range(160)]
    df = history(spark, {"regularized": regular, "unregularized": free})
    assert points(df)["regularized"] == (4, 0.07925, 24, True)
    train = df.withColumn("train", F.when((F.col("model") == "unregularized") & (F.col("iteration") == 160), 0.01497).otherwise(F.col("train")))
    gap = {r["model"]: r for r in M.overfit_gap(train).collect()}["unregularized"]
    assert (gap["lowest_iteration"], gap["rounds"]) == (1, 160) and gap["final_gap"] == pytest.approx(0.47881)


@pytest.mark.parametrize("patience, min_delta", [(1, 0.0), (3, 1.0), (8, 2.5)])
def test_stop_rule_equals_the_loop(spark, patience, min_delta):
    rng = random.Random(patience)
    curves = {f"m{k}": [rng.randrange(30) for _ in range(rng.randint(1, 40))] for k in range(300)}
    got = points(history(spark, curves), patience=patience, min_delta=min_delta)
    assert got == {m: stop_by_hand(c, patience, min_delta) for m, c in curves.items()}


def test_ties_go_to_the_first_round(spark):
    df = history(spark, {"m": [5, 3, 3, 3, 4]})
    assert points(df, patience=9, min_delta=0.0)["m"] == (2, 3.0, 5, False)
    assert M.overfit_gap(df).first()["lowest_iteration"] == 2


def residual_rows(spark, n=400):
    rng = np.random.default_rng(8)
    x, base = rng.uniform(0, 10, n), rng.uniform(20, 200, n)
    y = (base + 1) * np.exp(0.3 * (x > 5) + rng.normal(0, 0.05, n)) - 1
    rows = [(i, float(a), float(b), f"g{i % 3}", float(c)) for i, (a, b, c) in enumerate(zip(x, base, y))]
    df = spark.createDataFrame(rows, "id int, x double, lag1_y double, geo string, y double")
    return M.residual_frames(df.filter("id < 250"), [df.filter("id between 250 and 319"), df.filter("id >= 320")], ["x", "lag1_y"], "geo", "y", "lag1_y")


def test_residual_trees_beat_their_anchor_and_losses_are_right(spark):
    fit, valid, test = residual_rows(spark)
    setting = {"a": (12, 0.3, 3, 5, 0.9), "b": (5, 0.3, 2, 5, 1.0)}
    rows = {(r["model"], r["iteration"]): r for r in M.loss_history(setting, fit, valid).collect()}
    assert sorted(rows) == [("a", i) for i in range(13)] + [("b", i) for i in range(6)]
    assert rows["a", 0]["valid"] == pytest.approx(valid.agg(F.avg(F.col("resid") ** 2)).first()[0])
    assert rows["a", 12]["valid"] < 0.5 * rows["a", 0]["valid"]
    # the fit cut at a round is the beginning of the longer one
    model, (own, scored) = M.fit_residual_trees(fit, [valid, test], setting["a"], 4, "lag1_y")
    assert model.getNumTrees == 4
    assert own.agg(F.avg((F.col("resid") - F.col("resid_pred")) ** 2)).first()[0] == pytest.approx(rows["a", 4]["valid"])
    wrong = scored.filter(F.abs(F.col("prediction") - F.greatest(F.expr("(lag1_y + 1) * exp(resid_pred) - 1"), F.lit(0.0))) > 1e-6)
    assert wrong.count() == 0 and not fit.is_cached


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_rules_hold_over_the_written_tables(spark, tmp_path):
    """DuckDB applies the stopping rule, the winner of each fold and the acceptance rule to what the fits wrote."""
    from tessera.plans import modelling as MQ

    found, con = MQ._residual_trees(spark, SF), duckdb.connect()
    for name, df in (("history", found["history"]), ("scored", found["test"]), ("cv", MQ._gbt_fits(spark, SF)["cv"])):
        df.write.parquet(f"{tmp_path}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}/*.parquet')")
    rule = con.execute(f"""
        WITH RECURSIVE step(model, iteration, best, best_at, stop) AS (
          SELECT DISTINCT model, 0, CAST('inf' AS DOUBLE), 0, CAST(NULL AS INTEGER) FROM history
          UNION ALL
          SELECT h.model, h.iteration, CASE WHEN s.stop IS NULL AND h.valid < s.best - {K.STOP_MIN_DELTA} THEN h.valid ELSE s.best END,
                 CASE WHEN s.stop IS NULL AND h.valid < s.best - {K.STOP_MIN_DELTA} THEN h.iteration ELSE s.best_at END,
                 CASE WHEN s.stop IS NULL AND h.valid >= s.best - {K.STOP_MIN_DELTA} AND h.iteration - s.best_at >= {K.STOP_PATIENCE} THEN h.iteration ELSE s.stop END
          FROM step s JOIN history h ON h.model = s.model AND h.iteration = s.iteration + 1)
        SELECT model, arg_max(best_at, iteration), coalesce(max(stop), max(iteration)) FROM step GROUP BY model""").fetchall()
    assert sorted(rule) == sorted((r["model"], r["best_iteration"], r["stop_iteration"]) for r in found["points"].collect())
    errors = "avg(abs(a - greatest({0}, 0))), sqrt(avg((a - greatest({0}, 0)) ** 2)), sum(abs(a - greatest({0}, 0))) / sum(a)"
    model = con.execute(f"SELECT {errors.format('prediction')} FROM scored").fetchone()
    base = con.execute(f"SELECT {errors.format('lag1_a')} FROM scored").fetchone()
    got = {r["model"]: r for r in MQ.q_challenger_metrics(spark, SF).collect()}
    assert got["residual_trees"]["accepted"] == all(m < b for m, b in zip(model, base))
    assert got["residual_trees"]["mae"] == pytest.approx(model[0], abs=1e-6) and not got["persistence"]["accepted"]
    winners = con.execute("SELECT fold, avg(abs(a - greatest(prediction, 0))) < avg(abs(a - greatest(lag1_a, 0))) FROM cv GROUP BY fold").fetchall()
    assert dict(winners) == {r["fold"]: r["winner"] == "model" for r in MQ.q_gbt_cv(spark, SF).collect()}
    sweep = MQ._sweep(spark, SF)  # M11, V8: the largest silhouette, ties to the smaller k
    MQ.q_kmeans_sweep(spark, SF).write.parquet(f"{tmp_path}/sweep")
    chosen = con.execute(f"SELECT k FROM read_parquet('{tmp_path}/sweep/*.parquet') ORDER BY silhouette_sq DESC, k LIMIT 1").fetchone()[0]
    assert sweep["chosen"] == chosen and MQ.q_kmeans_final(spark, SF).select("cluster").distinct().count() == chosen
    pairs = MQ.q_hierarchy_by_cluster(spark, SF).agg(F.sum("n")).first()[0]  # M15: every geography in one cell of the contingency table
    assert pairs == MQ.q_bisecting_hierarchy(spark, SF).count()
