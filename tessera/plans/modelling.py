"""Model-backed registered queries.

Fits run on executors; the driver holds fitted parameters and small result rows. Fitted numbers have no SQL
oracle (Spark's estimators are not the reference's algorithms), but what surrounds them has: the ``*_checks``
keys return row counts, sums and baselines of the scored rows together with invariants of the fit, all of
which SQL can state from the given tables.

Fits shared by several keys are made once per application and input state (``input_key``: new data under the
same path fits anew) and their scored rows are written to shared storage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.operators import clustering as C
from tessera.operators import evaluate as E
from tessera.operators import models as M
from tessera.operators import panel as P
from tessera.operators import profile as PR
from tessera.plans.catalog import MEASURE, _iso, _profile, _r
from tessera.session import write_scratch
from tessera.sources.cube import read_table
from tessera.sources.store import load_clean, once

TOLERANCE = 1e-6


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return C.as_vector(e, "embedding")


def q_inertia_by_label(spark, d):
    i = C.inertia_by_label(_embeddings(spark, d))
    return i.select(_r("inertia").alias("inertia"), "n_points", "n_clusters")


def q_silhouette_sq(spark, d):
    points = _embeddings(spark, d)
    value = C.silhouette_sq(points)
    return points.where(F.col("label").isNotNull()).agg(
        F.round(F.lit(value), 6).alias("silhouette_sq"), F.count(F.lit(1)).cast("bigint").alias("n_points"))


# --------------------------------------------------------------------------
# Profile clustering
# --------------------------------------------------------------------------

def _profile_matrix(spark, d) -> DataFrame:
    """52x7-style matrix: standardized (population std) profile as a vector, written once."""
    return once(spark, d, "matrix", lambda: _build_profile_matrix(spark, d))


def _build_profile_matrix(spark, d) -> DataFrame:
    prof = _profile(spark, d)
    nulls = prof.agg(*[F.sum(F.col(f).isNull().cast("int")).alias(f) for f in PR.PROFILE_FEATURES]).first()
    if any(nulls):
        raise ValueError(f"profile has missing values: {nulls.asDict()}")
    scaler = M.PopulationScaler(PR.PROFILE_FEATURES).fit(prof)
    z = scaler.transform(prof)
    X = VectorAssembler(inputCols=scaler.output_cols(), outputCol="features").transform(z)
    return write_scratch(X, "profile-matrix")


def _sweep(spark, d) -> dict:
    """rows (k, inertia, silhouette, seed) and, for the chosen k, all its fits."""
    return once(spark, d, "sweep", lambda: _run_sweep(_profile_matrix(spark, d)))


def _run_sweep(X: DataFrame) -> dict:
    with M.kept(X) as points:
        fits = M.kmeans_fits(points, "features", K.KMEANS_KS, K.KMEANS_RESTARTS)
        best = {k: M.best_fit(f) for k, f in fits.items()}
        rows = []
        for k, (cost, seed, model) in best.items():
            pred = model.transform(points).withColumn("prediction", F.col("prediction").cast("int"))
            rows.append((k, cost, float(C.silhouette_sq(pred, "features", "prediction")), seed))
        chosen = min(rows, key=lambda r: (-r[2], r[0]))[0]
        more = K.KMEANS_FINAL_RESTARTS - K.KMEANS_RESTARTS
        final = fits[chosen] + M.kmeans_fits(points, "features", [chosen], more, K.SEED + K.KMEANS_RESTARTS)[chosen]
    return {"rows": rows, "best": best, "chosen": chosen, "final": M.best_fit(final)}


def q_kmeans_sweep(spark, d):
    return spark.createDataFrame(_sweep(spark, d)["rows"], "k int, inertia double, silhouette_sq double, seed int")


def _kmeans_groups(spark, d) -> DataFrame:
    """The profile matrix with the groups of the final fit, relabelled by mean share."""
    pred = _sweep(spark, d)["final"][2].transform(_profile_matrix(spark, d)).withColumnRenamed("prediction", "grp")
    return PR.relabel_groups(pred, "a_pct_total").withColumnRenamed("new_group", "cluster")


def q_kmeans_final(spark, d):
    proj, _ = M.pca_2d(_kmeans_groups(spark, d), "features")
    return proj.select("geo", "cluster", *[_r(f).alias(f) for f in PR.PROFILE_FEATURES],
                       _r("pc1").alias("pc1"), _r("pc2").alias("pc2"))


def q_kmeans_checks(spark, d):
    """Per k of the sweep the points, groups in use, and whether the cost equals the recomputed
    inertia and does not rise with k; the last row (k = 0) is the final fit, whose labels must be dense and ordered by mean share."""
    X, sweep = _profile_matrix(spark, d), _sweep(spark, d)
    out, before = None, None
    for k, (cost, _, model) in sweep["best"].items():
        pred = model.transform(X)
        row = C.inertia_by_label(pred, "features", "prediction").select(
            F.lit(k).alias("k"), "n_points", (F.col("n_clusters") == k).alias("all_groups_used"),
            (F.abs(F.col("inertia") - cost) <= TOLERANCE * (1 + cost)).alias("cost_is_inertia"),
            F.lit(before is None or cost <= before + TOLERANCE).alias("in_order"))
        out, before = row if out is None else out.unionByName(row), cost
    groups = _kmeans_groups(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("a_pct_total").alias("m"))
    ranked = groups.agg(F.sum("n").cast("bigint").alias("n_points"), F.sort_array(F.collect_list(F.struct("cluster", "m"))).alias("g"))
    labels, means = F.transform("g", lambda x: x["cluster"]), F.transform("g", lambda x: x["m"])
    cost, _, model = sweep["final"]
    again = C.inertia_by_label(model.transform(X), "features", "prediction").first()["inertia"]
    final = ranked.select(
        F.lit(0).alias("k"), "n_points", (labels == F.sequence(F.lit(0), F.lit(sweep["chosen"] - 1))).alias("all_groups_used"),
        F.lit(abs(again - cost) <= TOLERANCE * (1 + cost)).alias("cost_is_inertia"), (means == F.sort_array(means)).alias("in_order"))
    return out.unionByName(final)


def q_pca_2d(spark, d):
    X = _profile_matrix(spark, d)
    proj, ratio = M.pca_2d(X, "features")
    return proj.select("geo", _r("pc1").alias("pc1"), _r("pc2").alias("pc2"),
                       F.lit(round(100 * sum(ratio), 4)).alias("variance_2d_pct"))


def q_pca_checks(spark, d):
    """The components are uncorrelated, and their variances are the stated shares of the variance of the standardized
    features (one per varying feature)."""
    proj, ratio = M.pca_2d(_profile_matrix(spark, d), "features")
    n = F.count(F.lit(1))
    spread = [F.var_pop(vector_to_array("features")[i]) for i in range(len(PR.PROFILE_FEATURES))]
    total = sum(spread[1:], spread[0])
    near = lambda a, b: F.abs(a - b) <= TOLERANCE * 10
    return proj.agg(
        n.cast("bigint").alias("n_geos"), near(F.covar_pop("pc1", "pc2"), F.lit(0.0)).alias("uncorrelated"),
        near(F.var_pop("pc1") / total, F.lit(ratio[0])).alias("share1_ok"), near(F.var_pop("pc2") / total, F.lit(ratio[1])).alias("share2_ok"),
        (F.var_pop("pc1") >= F.var_pop("pc2")).alias("in_order"))


def _hierarchy(spark, d) -> DataFrame:
    return M.bisecting_hierarchy(_profile_matrix(spark, d), "features", 4)


def q_bisecting_hierarchy(spark, d):
    return _hierarchy(spark, d).select("geo", "hier")


def q_hierarchy_by_cluster(spark, d):
    """Contingency table of the hierarchy against the k-means groups."""
    both = _hierarchy(spark, d).select("geo", "hier").join(_kmeans_groups(spark, d).select("geo", "cluster"), "geo")
    return both.groupBy("hier", "cluster").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# --------------------------------------------------------------------------
# Forecast models
# --------------------------------------------------------------------------

def _split_panel(spark, d) -> DataFrame:
    return P.tag_split(P.lag_panel(load_clean(spark, d), MEASURE))


def _scored_frame(df: DataFrame) -> DataFrame:
    return df.select("geo", _iso("start_date"), MEASURE, f"lag1_{MEASURE}", _r("prediction").alias("prediction"),
                     _r(F.abs(F.col(MEASURE) - F.col("prediction"))).alias("absolute_error"))


_SCORED = ["geo", "start_date", MEASURE, f"lag1_{MEASURE}", "prediction"]


GBT_FITS = ("test", "early", "cv")


def _gbt_fits(spark, d, *names: str) -> dict:
    """Of the final boosted-tree fit, its early-stopping twin and the three expanding-fold fits those named (default: all), each
    made once per input state: a query waits for the fits that it reports and no others."""
    done = once(spark, d, "gbt", dict)
    wanted = [n for n in names or GBT_FITS if n not in done]
    if wanted:
        done.update(_run_gbt(spark, d, wanted))
    return done


def _gbt_panel(spark, d) -> DataFrame:
    return once(spark, d, "gbt-panel", lambda: write_scratch(P.lag_panel(load_clean(spark, d), MEASURE), "lag-panel"))


def _run_gbt(spark, d, names: list[str]) -> dict:
    """Independent fits, trained as concurrent jobs."""
    panel = _gbt_panel(spark, d)
    p, three, folds = P.tag_split(panel), P.tag_three_way(panel), P.fold_rows(panel)
    numeric = P.numeric_features(MEASURE)

    def final():
        _, (test,) = M.fit_gbt_forecast(p.filter(F.col("split") == "train"), [p.filter(F.col("split") == "test")], numeric, "geo", MEASURE)
        return write_scratch(test.select(_SCORED), "gbt-test")

    def fold(label):
        f = folds.filter(F.col("fold") == label)
        train, valid = f.filter(F.col("role") == "train"), f.filter(F.col("role") == "validation")
        _, (scored,) = M.fit_gbt_forecast(train, [valid], numeric, "geo", MEASURE)
        return write_scratch(scored.select(F.lit(label).alias("fold"), *_SCORED), "gbt-fold")

    def early():
        split = lambda s: three.filter(F.col("split") == s)
        model, (test,) = M.fit_gbt_early_stopping(split("fit"), split("validation"), [split("test")], numeric, "geo", MEASURE)
        return model.getNumTrees, write_scratch(test.select(_SCORED), "gbt-early")

    fits = {"test": [final], "early": [early], "cv": [lambda lbl=lbl: fold(lbl) for lbl, _, _ in K.FOLDS]}
    made = iter(M.parallel_fits([f for n in names for f in fits[n]]))
    out = {n: [next(made) for _ in fits[n]] for n in names}
    return {n: reduce(DataFrame.unionByName, rows) if n == "cv" else rows[0] for n, rows in out.items()}


def _gbt_test(spark, d) -> DataFrame:
    """Boosted-tree predictions on the test rows."""
    return _gbt_fits(spark, d, "test")["test"]


def q_gbt_forecast(spark, d):
    return _scored_frame(_gbt_test(spark, d))


def q_gbt_cv(spark, d):
    scored = _gbt_fits(spark, d, "cv")["cv"]
    sizes = P.fold_sizes(_split_panel(spark, d))
    model = E.regression_metrics(scored, MEASURE, "prediction", ["fold"])
    base = E.regression_metrics(scored, MEASURE, f"lag1_{MEASURE}", ["fold"])
    names = ["mae", "rmse", "r2", "wape_pct"]
    out = sizes.join(model.select("fold", *[F.col(c).alias("model_" + c) for c in names]), "fold").join(
        base.select("fold", *[F.col(c).alias("baseline_" + c) for c in names]), "fold")
    # Fold winner on MAE
    return out.withColumn("winner", F.when(F.col("model_mae") < F.col("baseline_mae"), F.lit("model"))
                          .otherwise(F.lit("baseline")))


def _row_checks(scored: DataFrame, by: list[str]) -> DataFrame:
    """What SQL can say about scored rows: their number, sums, persistence metrics, and that no prediction is missing or negative."""
    metrics = E.metric_columns(MEASURE, f"lag1_{MEASURE}")[1:]
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.count_distinct("geo").cast("bigint").alias("geos"), F.sum(MEASURE).alias("actual"),
        F.sum(f"lag1_{MEASURE}").alias("persistence"), *[_r(m).alias(f"baseline_{n}") for m, n in zip(metrics, ["mae", "rmse", "r2", "wape_pct"])],
        F.min((F.coalesce("prediction", F.lit(-1.0)) >= 0).cast("int")).cast("boolean").alias("predictions_ok"))


def q_gbt_cv_checks(spark, d):
    """The fold fits' scored rows, and that the stated winner is the one with the smaller sum of errors over the written predictions."""
    scored = _gbt_fits(spark, d, "cv")["cv"]
    off = lambda c: F.sum(F.abs(F.col(MEASURE) - F.greatest(F.col(c), F.lit(0.0))))
    ahead = scored.groupBy("fold").agg((off("prediction") < off(f"lag1_{MEASURE}")).alias("model_ahead"))
    cv = q_gbt_cv(spark, d).select("fold", "train_rows", "validation_rows", "winner")
    right = ((F.col("winner") == "model") == F.col("model_ahead")).alias("winner_ok")
    return _row_checks(scored, ["fold"]).join(cv.join(ahead, "fold").select("fold", "train_rows", "validation_rows", right), "fold")


def q_forecast_checks(spark, d):
    """The test rows that each model family scored."""
    out = None
    for name, scored in (("trees", _gbt_test(spark, d)), ("trees_early", _gbt_fits(spark, d, "early")["early"][1]), ("residual_linear", _residual_test(spark, d)),
                         ("residual_trees", _residual_trees(spark, d)["test"])):
        rows = _row_checks(scored.withColumn("model", F.lit(name)), ["model"])
        out = rows if out is None else out.unionByName(rows)
    return out


def _residual_test(spark, d) -> DataFrame:
    """Huber residual-regression predictions on the test rows."""
    def fit():
        p = write_scratch(_split_panel(spark, d), "split-panel")
        _, (test,) = M.fit_residual_linear(p.filter(F.col("split") == "train"), [p.filter(F.col("split") == "test")],
                                           P.numeric_features(MEASURE), "geo", MEASURE, f"lag1_{MEASURE}")
        return write_scratch(test.select(_SCORED), "residual-test")

    return once(spark, d, "residual", fit)


CHALLENGER = "regularized"


def _residual_trees(spark, d) -> dict:
    """M18(b), M19, M20: the losses of both fits, where they stop, and the test rows scored by the regularized one, cut at its best round."""
    def fit():
        three = write_scratch(P.tag_three_way(P.lag_panel(load_clean(spark, d), MEASURE)), "three-way-panel")
        split = lambda s: three.filter(F.col("split") == s)
        base = f"lag1_{MEASURE}"
        own, valid, test = M.residual_frames(split("fit"), [split("validation"), split("test")], P.numeric_features(MEASURE), "geo", MEASURE, base)
        history = write_scratch(M.loss_history(K.RESIDUAL_TREES, own, valid), "loss-history")
        points = write_scratch(M.early_stop_points(history), "early-stop")
        rounds = points.filter(F.col("model") == CHALLENGER).first()["best_iteration"]
        _, (scored,) = M.fit_residual_trees(own, [test], K.RESIDUAL_TREES[CHALLENGER], rounds, base)
        return {"panel": three, "history": history, "points": points, "test": write_scratch(scored.select(_SCORED), "residual-trees-test")}

    return once(spark, d, "residual-trees", fit)


def q_loss_histories(spark, d):
    """Training and validation loss after every round; round 0 is the persistence forecast."""
    return _residual_trees(spark, d)["history"].select("model", "iteration", _r("train").alias("train"), _r("valid").alias("valid"))


def q_early_stop_point(spark, d):
    return _residual_trees(spark, d)["points"].withColumn("best_valid", _r("best_valid"))


def q_overfit_gap(spark, d):
    gaps = M.overfit_gap(_residual_trees(spark, d)["history"])
    return gaps.select(*[_r(c).alias(c) if t == "double" else F.col(c) for c, t in gaps.dtypes])


def q_loss_history_checks(spark, d):
    """Per fit the rounds, rows and losses of the anchor, that boosting ended below it on its own rows, and that the stop point obeys
    the rule: no better round up to the stop, and the stop ``patience`` rounds after the best or at the end."""
    found = _residual_trees(spark, d)
    sizes = found["panel"].agg(*[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("fit", "validation")])
    history, points = found["history"], found["points"].select("model", "best_iteration", "best_valid", "stop_iteration", "stopped_early")
    joined = history.join(points, "model")
    waited = (F.col("iteration") > F.col("best_iteration")) & (F.col("iteration") <= F.col("stop_iteration"))
    better = waited & (F.col("valid") < F.col("best_valid") - F.lit(K.STOP_MIN_DELTA))
    at_best = F.max(F.when(F.col("iteration") == F.col("best_iteration"), F.col("valid")))
    anchor = lambda c: F.max(F.when(F.col("iteration") == 0, F.col(c)))
    ends = F.when(F.col("stopped_early"), F.col("stop_iteration") - F.col("best_iteration") == K.STOP_PATIENCE).otherwise(F.col("stop_iteration") == F.col("rounds"))
    per = joined.groupBy("model", "best_iteration", "best_valid", "stop_iteration", "stopped_early").agg(
        F.max("iteration").alias("rounds"), F.count("valid").alias("losses"), anchor("train").alias("anchor_train"), anchor("valid").alias("anchor_valid"),
        F.max_by("train", "iteration").alias("last_train"), F.count_if(better).alias("missed"), at_best.alias("at_best"))
    checked = per.select("model", F.col("rounds").cast("int").alias("rounds"), (F.col("losses") == F.col("rounds") + 1).alias("complete"),
                         _r("anchor_train").alias("anchor_train"), _r("anchor_valid").alias("anchor_valid"), (F.col("last_train") < F.col("anchor_train")).alias("learned"),
                         ((F.col("missed") == 0) & (F.col("at_best") == F.col("best_valid")) & ends).alias("rule_ok"))
    return checked.join(F.broadcast(sizes), F.lit(True))  # one row


def q_residual_trees(spark, d):
    return _scored_frame(_residual_trees(spark, d)["test"])


def q_challenger_metrics(spark, d):
    """The challengers (linear and boosted-tree residual models) beside persistence on identical rows; a challenger is
    accepted only if MAE, RMSE and WAPE all beat the baseline's."""
    keys = ["geo", "start_date"]
    linear = _residual_test(spark, d).select(*keys, F.col("prediction").alias("residual_linear"))
    rows = _residual_trees(spark, d)["test"].withColumnRenamed("prediction", "residual_trees").join(linear, keys)
    base = f"lag1_{MEASURE}"
    m = E.long_model_metrics(rows, MEASURE, {"residual_trees": "residual_trees", "residual_linear": "residual_linear", "persistence": base}, baseline=base)
    own = rows.agg(*[c.alias(f"base_{n}") for n, c in zip(("rmse", "wape_pct"), E.metric_columns(MEASURE, base)[2:5:2])])
    accepted = E.acceptance("mae", "rmse", "wape_pct", "base_mae", "base_rmse", "base_wape_pct")
    both = m.join(F.broadcast(own), F.lit(True))  # one row
    return both.select("model", "n", *[_r(c).alias(c) for c in ["mae", "rmse", "r2", "wape_pct"]],
                       _r(E.improvement_pct("base_mae", "mae")).alias("mae_improvement_pct"), accepted.alias("accepted"))


def q_residual_linear(spark, d):
    return _scored_frame(_residual_test(spark, d))


def q_gbt_metrics(spark, d):
    """E1-E5 for the boosted trees against persistence on the same rows."""
    m = E.long_model_metrics(_gbt_test(spark, d), MEASURE, {"gbt": "prediction", "persistence": f"lag1_{MEASURE}"},
                             baseline=f"lag1_{MEASURE}")
    return m.select("model", "n", *[_r(c).alias(c) for c in ["mae", "rmse", "r2", "wape_pct"]],
                    _r(E.improvement_pct("base_mae", "mae")).alias("mae_improvement_pct"))


def q_forecast_monthly_models(spark, d):
    """Per test month, rows and the sums of actual, boosted-tree, residual-regression and persistence
    forecasts on identical rows."""
    trees = _gbt_test(spark, d).withColumnRenamed("prediction", "trees")
    linear = _residual_test(spark, d).select("geo", "start_date", F.col("prediction").alias("residual_linear"))
    g = trees.join(linear, ["geo", "start_date"]).groupBy("start_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum(MEASURE).alias("actual"),
        F.sum("trees").alias("trees"),
        F.sum("residual_linear").alias("residual_linear"),
        F.sum(f"lag1_{MEASURE}").alias("persistence"),
    )
    return g.select(_iso("start_date"), "rows", "actual", _r("trees", 3).alias("trees"),
                    _r("residual_linear", 3).alias("residual_linear"), "persistence")


def q_monthly_model_checks(spark, d):
    """The model-free columns of the monthly rollup, which compares all models on identical rows."""
    return q_forecast_monthly_models(spark, d).select(
        "start_date", "rows", "actual", "persistence", ((F.col("trees") >= 0) & (F.col("residual_linear") >= 0)).alias("predictions_ok"))


def q_gbt_early_stopping(spark, d):
    """M19 twin: boosted trees with validation-based early stopping (fit /
    validation / test split); trees used and test metrics."""
    n_trees, test = _gbt_fits(spark, d, "early")["early"]
    m = E.regression_metrics(test, MEASURE, "prediction")
    return m.select(F.lit(n_trees).alias("trees_used"), F.lit(K.GBT_ROUNDS).alias("max_trees"), "n",
                    *[_r(c).alias(c) for c in ["mae", "rmse", "r2", "wape_pct"]])


MODEL_QUERIES = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
