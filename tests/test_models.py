import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import clustering as C
from tessera.operators import models as M
from tessera.operators import profile as PR


def _points(spark, X, labels):
    return spark.createDataFrame([(i, [float(v) for v in x], int(l)) for i, (x, l) in enumerate(zip(X, labels))],
                                 "vec_id long, embedding array<double>, label int").withColumn(
        "features", array_to_vector("embedding"))


def _brute_silhouette(X, labels, sq=True):
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    if not sq:
        D = np.sqrt(D)
    s = []
    for i, li in enumerate(labels):
        own = labels == li
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, labels == c].mean() for c in set(labels) if c != li)
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_sq_brute_force(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(30, 4))
    labels = np.array([0] * 10 + [1] * 12 + [2] * 7 + [3])  # one single-member cluster
    df = _points(spark, X, labels)
    want = _brute_silhouette(X, labels)
    assert C.silhouette_sq(df) == pytest.approx(want, abs=1e-9)


def test_inertia_matches_manual(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(20, 3))
    labels = np.array([0, 1] * 10)
    want = sum(((X[labels == c] - X[labels == c].mean(0)) ** 2).sum() for c in (0, 1))
    got = C.inertia_by_label(_points(spark, X, labels)).first().inertia
    assert got == pytest.approx(want)


def test_population_scaler_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = PR.standardize(df, ["x", "k"]).collect()
    assert [r.x for r in out] == [-1.0, 1.0]  # population std = 1
    assert [r.k for r in out] == [0.0, 0.0]


def test_one_hot_unknown_is_zero(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "geo string")
    allc = spark.createDataFrame([("a",), ("c",), ("zz",)], "geo string")
    out = {r.geo: (r.slot, r.n_slots) for r in M.one_hot_slots(train, allc, "geo").collect()}
    assert out == {"a": (0, 3), "c": (2, 3), "zz": (None, 3)}


def test_kmeans_cost_equals_inertia(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 1, (15, 2)), rng.normal(6, 1, (15, 2))])
    df = _points(spark, X, np.zeros(30, dtype=int))
    fits = M.kmeans_fits(df, "features", [2, 3], restarts=3)
    assert {k: len(f) for k, f in fits.items()} == {2: 3, 3: 3} and [s for _, s, _ in fits[2]] == [42, 43, 44]
    cost, _, model = M.best_fit(fits[2])
    assert cost == min(c for c, _, _ in fits[2])
    assert cost == pytest.approx(C.inertia_by_label(model.transform(df), "features", "prediction").first().inertia)


def test_unlabelled_points_do_not_count(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(21, 3))
    labels = np.array([0, 1, 2] * 7)
    df = _points(spark, X, labels)
    more = df.unionByName(df.limit(5).withColumn("label", F.lit(None).cast("int")))
    assert C.inertia_by_label(more).first() == C.inertia_by_label(df).first()
    assert C.silhouette_sq(more) == C.silhouette_sq(df)


def test_design_matrix_learns_from_train_only(spark):
    train = spark.createDataFrame([(1.0, 5.0, "b"), (3.0, 5.0, "a")], "x double, z double, geo string")
    other = spark.createDataFrame([(100.0, 6.0, "zz"), (1.0, 5.0, "a")], "x double, z double, geo string")
    pm, (xt, xo) = M.design_matrix(train, [other], ["x", "z"], "geo")
    assert [r.features.toArray().tolist() for r in xt.orderBy("x").collect()] == [[-1, 0, 0, 1], [1, 0, 1, 0]]
    assert [r.features.toArray().tolist() for r in xo.orderBy("x").collect()] == [[-1, 0, 1, 0], [98, 1, 0, 0]]
    assert M.vector_size(xt) == 4
    assert not train.is_cached and not xt.is_cached


def test_pca_sign_and_shares(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(40, 3)) * [3, 1, 0.2]
    X -= X.mean(0)
    proj, ratio = M.pca_2d(_points(spark, X, np.zeros(40, int)), "features")
    values, vectors = np.linalg.eigh(X.T @ X)
    order = np.argsort(-values)
    assert ratio == pytest.approx((values[order] / values.sum())[:2].tolist())
    for k, name in enumerate(("pc1", "pc2")):
        v = vectors[:, order[k]]
        v = v if v[np.abs(v).argmax()] > 0 else -v
        got = [r[name] for r in proj.orderBy("vec_id").collect()]
        assert got == pytest.approx((X @ v).tolist())


def test_gbt_early_stopping_stops(spark):
    rng = np.random.default_rng(5)
    xs = rng.uniform(0, 10, 300)
    rows = [(i, float(x), float(x % 7), "g%d" % (i % 3), float(10.0 + 3 * x + rng.normal())) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "id int, x double, z double, geo string, y double")
    fit, val, test = df.filter("id < 200"), df.filter("id >= 200 AND id < 260"), df.filter("id >= 260")
    model, (scored,) = M.fit_gbt_early_stopping(fit, val, [test], ["x", "z"], "geo", "y", max_iter=200, tol=0.01)
    assert model.getNumTrees < 200
    assert scored.filter(F.col("prediction").isNull()).count() == 0


def test_fits_read_as_many_partitions_as_their_rows_need(spark):
    df = spark.range(200).repartition(64)
    with M.kept(df) as rows:
        assert rows.rdd.getNumPartitions() == 1 and rows.count() == 200
    assert not rows.is_cached
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(M, "FIT_ROWS", 50)
        with M.kept(df) as rows:
            assert rows.rdd.getNumPartitions() == 4
    with M.kept(df.where("id < 0")) as rows:
        assert rows.count() == 0


def test_a_query_waits_for_the_boosted_trees_it_reports(spark, monkeypatch):
    from tessera.plans import modelling as MQ

    rows = [(f"g{g}", f"{1996 + m // 12}-{1 + m % 12:02d}-01", float(10 * g + m), float(m), float(10 * g + m + 1)) for g in range(3) for m in range(84)]
    panel = spark.createDataFrame(rows, "geo string, start_date string, a double, lag1_a double, prediction double").withColumn("start_date", F.to_date("start_date"))
    kept, called = {}, []
    monkeypatch.setattr(MQ, "once", lambda spark, d, name, make: kept[name] if name in kept else kept.setdefault(name, make()))
    monkeypatch.setattr(MQ, "load_clean", lambda spark, d: panel)
    monkeypatch.setattr(MQ.P, "lag_panel", lambda clean, measure: clean)

    class Model:
        getNumTrees = 7

    def fake(name):
        return lambda fit, *more: (called.append(name), (Model(), [f for part in more if isinstance(part, list) for f in part if not isinstance(f, str)]))[1]

    monkeypatch.setattr(MQ.M, "fit_gbt_early_stopping", fake("early"))
    monkeypatch.setattr(MQ.M, "fit_gbt_forecast", fake("forecast"))
    assert MQ.q_gbt_early_stopping(spark, "x").first()["trees_used"] == 7 and called == ["early"]
    assert MQ.q_gbt_forecast(spark, "x").count() > 0 and called == ["early", "forecast"]
    assert sorted(MQ._gbt_fits(spark, "x")) == ["cv", "early", "test"] and called == ["early"] + ["forecast"] * 4
    MQ.q_gbt_early_stopping(spark, "x"), MQ._gbt_fits(spark, "x", "cv")
    assert len(called) == 5
