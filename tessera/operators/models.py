"""Feature pipelines and distributed models (M3, M4, M9-M21) on pyspark.ml.

Spark's estimators differ in algorithm from the single-machine ones the
reference used (histogram boosting); results agree in semantics,
not digits. Every fit runs on executors; only fitted parameters (centroids,
coefficients, one loss per round) reach the driver.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import OneHotEncoder, PCA, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.functions import features as X
from tessera.operators.profile import apply_scaler, fit_population_scaler


# --------------------------------------------------------------------------
# M3 / M4: encoding and the column transformer
# --------------------------------------------------------------------------

def category_encoder(col: str, out: str) -> list:
    """Alphabetical categories, unknown -> all-zero vector of size k.

    ``handleInvalid='keep'`` appends the unknown slot last and
    ``dropLast=True`` drops exactly that slot.
    """
    return [
        StringIndexer(inputCol=col, outputCol=f"{col}__idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{col}__idx"], outputCols=[out], dropLast=True),
    ]


def one_hot_slots(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """Long form of the encoding: for each distinct category of ``df`` its
    active slot (null = unknown, all zeros) and the vector size."""
    model = Pipeline(stages=category_encoder(col, "__oh")).fit(train.select(col))
    enc = model.transform(df.select(col).distinct())
    arr = vector_to_array("__oh")
    pos = F.array_position(arr, 1.0)
    return enc.select(col, F.when(pos > 0, (pos - 1).cast("int")).alias("slot"),
                      F.size(arr).cast("int").alias("n_slots"))


class PopulationScaler:
    """M2 as a fit/transform pair (population std, zero variance -> 1)."""

    def __init__(self, features: list[str], suffix: str = "__z"):
        self.features, self.suffix, self.params = features, suffix, None

    def fit(self, df: DataFrame) -> "PopulationScaler":
        self.params = fit_population_scaler(df, self.features)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return apply_scaler(df, self.params, self.suffix)

    def output_cols(self) -> list[str]:
        return [f + self.suffix for f in self.features]


def scaler_stage(scaler: "PopulationScaler") -> SQLTransformer:
    """The fitted scaler as a pipeline stage, its parameters as literals, so that a saved pipeline scores new rows."""
    z = ", ".join(f"({f} - ({float(m or 0)!r}D)) / ({float(s)!r}D) AS {f}{scaler.suffix}" for f, (m, s) in scaler.params.items())
    return SQLTransformer(statement=f"SELECT *, {z} FROM __THIS__")


def design_matrix(train: DataFrame, others: list[DataFrame], numeric: list[str], category: str,
                  out: str = "features"):
    """M4: scale numerics (population std) + one-hot the category, fitted on
    ``train`` only; returns (pipeline_model, [train, *others] transformed). The
    pipeline holds the scaler, so it works on raw rows."""
    with kept(train.select(*numeric, category)) as rows:
        scaler = PopulationScaler(numeric).fit(rows)
        stages = [scaler_stage(scaler), *category_encoder(category, "__cat"),
                  VectorAssembler(inputCols=scaler.output_cols() + ["__cat"], outputCol=out)]
        pm = Pipeline(stages=stages).fit(rows)
    return pm, [pm.transform(x) for x in [train, *others]]


def vector_size(df: DataFrame, col: str = "features") -> int:
    """Feature count from the ML attribute metadata (no data pass)."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(df.select(col).first()[0])


# --------------------------------------------------------------------------
# Clustering of the profile matrix
# --------------------------------------------------------------------------

def parallel_fits(fns, max_workers: int = 8) -> list:
    """Run independent fits as concurrent Spark jobs from driver threads
    (each fit is a sequence of small jobs; threads keep every core busy)."""
    from concurrent.futures import ThreadPoolExecutor

    fns = list(fns)
    if len(fns) <= 1:
        return [f() for f in fns]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(fns))) as pool:
        return [f.result() for f in [pool.submit(fn) for fn in fns]]


def kmeans_fits(df: DataFrame, features_col: str, ks, restarts: int, first_seed: int = K.SEED) -> dict[int, list]:
    """M9: all (k, restart) fits, run concurrently: k -> [(training cost, seed, model)], one entry per seed. The solver is named: the
    default one makes a pass in every fit to choose it."""
    grid = [(k, first_seed + r) for k in ks for r in range(restarts)]
    fitted = parallel_fits(
        lambda k=k, s=s: KMeans(k=k, seed=s, featuresCol=features_col, maxIter=300, tol=1e-6, solver="row").fit(df)
        for k, s in grid)
    out: dict[int, list] = {}
    for (k, s), m in zip(grid, fitted):
        out.setdefault(k, []).append((float(m.summary.trainingCost), s, m))
    return out


def best_fit(fits: list) -> tuple:
    """The fit with the lowest cost; ties go to the smallest seed."""
    return min(fits, key=lambda f: f[:2])


def pca_2d(df: DataFrame, features_col: str, k: int = 2):
    """Projection with a deterministic sign (largest loading positive).

    Returns (projected DataFrame with pc1..pck, explained variance ratio list).
    ml.PCA does not center on transform, so feed standardized input.
    """
    model = PCA(k=k, inputCol=features_col, outputCol="__pcs").fit(df)
    pc = model.pc.toArray()
    signs = []
    for j in range(k):
        col = pc[:, j]
        i = int(abs(col).argmax())
        signs.append(1.0 if col[i] >= 0 else -1.0)
    arr = vector_to_array("__pcs")
    out = model.transform(df).select(
        "*", *[(arr[j] * F.lit(signs[j])).alias(f"pc{j + 1}") for j in range(k)]).drop("__pcs")
    return out, [float(v) for v in model.explainedVariance.toArray()]


def bisecting_hierarchy(df: DataFrame, features_col: str, k: int, seed: int = 42) -> DataFrame:
    """M15 (re-aimed Ward view): divisive hierarchy assignment."""
    model = BisectingKMeans(k=k, seed=seed, featuresCol=features_col, predictionCol="hier").fit(df)
    return model.transform(df)


# --------------------------------------------------------------------------
# Forecasting models
# --------------------------------------------------------------------------

#: Rows that one task of an iterative fit reads.
FIT_ROWS = 50_000


@contextmanager
def kept(df: DataFrame):
    """Cache ``df`` for the many passes of an iterative fit and let it go afterwards. Its partitions follow its rows, not
    the session's shuffle partitions: a fit is thousands of jobs, each with a task for every partition."""
    df = df.coalesce(max(1, -(-df.count() // FIT_ROWS))).cache()
    try:
        yield df
    finally:
        df.unpersist()


def gbt_model(features_col: str = "features", label_col: str = "log_target", max_iter: int = K.GBT_ROUNDS,
              seed: int = K.SEED) -> GBTRegressor:
    """Boosted trees on the log1p target (depth 4 ~ 15 leaves)."""
    return GBTRegressor(featuresCol=features_col, labelCol=label_col, predictionCol="log_pred",
                        stepSize=K.GBT_LEARNING_RATE, maxIter=max_iter, maxDepth=K.GBT_DEPTH,
                        minInstancesPerNode=K.GBT_MIN_LEAF, maxBins=K.GBT_MAX_BINS, subsamplingRate=1.0, seed=seed)


def fit_gbt_forecast(train: DataFrame, scored: list[DataFrame], numeric: list[str], category: str,
                     target: str, max_iter: int = K.GBT_ROUNDS, seed: int = K.SEED):
    """M16 + M21: fit on ``train`` (log1p target), score others, clip at 0."""
    train = train.withColumn("log_target", X.log_target(target))
    _, frames = design_matrix(train, scored, numeric, category)
    with kept(frames[0]) as fitted:
        model = gbt_model(max_iter=max_iter, seed=seed).fit(fitted)
    out = [model.transform(f).withColumn("prediction", X.inverse_log_target("log_pred")) for f in frames[1:]]
    return model, out


def fit_gbt_early_stopping(fit: DataFrame, valid: DataFrame, scored: list[DataFrame], numeric: list[str],
                           category: str, target: str, max_iter: int = K.GBT_ROUNDS, tol: float = K.GBT_EARLY_STOP_TOL,
                           seed: int = K.SEED):
    """M19 (boosted-tree twin): stop adding trees once the validation error
    stops improving by ``tol`` (relative). The feature pipeline is fitted on
    the fit rows only; validation rows are flagged, not trained on."""
    fit = fit.withColumn("log_target", X.log_target(target))
    valid = valid.withColumn("log_target", X.log_target(target))
    _, frames = design_matrix(fit, [valid, *scored], numeric, category)
    both = frames[0].withColumn("is_val", F.lit(False)).unionByName(frames[1].withColumn("is_val", F.lit(True)))
    est = gbt_model(max_iter=max_iter, seed=seed).setValidationIndicatorCol("is_val")
    est.set(est.validationTol, tol)
    with kept(both) as rows:
        model = est.fit(rows)
    out = [model.transform(f).withColumn("prediction", X.inverse_log_target("log_pred")) for f in frames[2:]]
    return model, out


def fit_residual_linear(train: DataFrame, scored: list[DataFrame], numeric: list[str], category: str,
                        target: str, base: str, reg: float = K.HUBER_REG):
    """M18(a): Huber regression of log1p(y) - log1p(base); prediction =
    max(expm1(log1p(base) + r), 0), so a zero output is the persistence
    forecast."""
    train = train.withColumn("resid", X.residual_target(target, base))
    _, frames = design_matrix(train, scored, numeric, category)
    lr = LinearRegression(featuresCol="features", labelCol="resid", predictionCol="resid_pred",
                          loss="huber", epsilon=K.HUBER_EPSILON, regParam=reg, elasticNetParam=0.0, maxIter=200)
    with kept(frames[0]) as fitted:  # every L-BFGS step is a pass over it
        model = lr.fit(fitted)
    out = [model.transform(f).withColumn("prediction", X.residual_reconstruct(base, "resid_pred"))
           for f in frames[1:]]
    return model, out


# --------------------------------------------------------------------------
# M18(b), M19, M20: boosted trees on the log residual, their losses and where to stop
# --------------------------------------------------------------------------

HISTORY = "model string, iteration int, train double, valid double"


def residual_trees(settings: tuple, rounds: int | None = None, seed: int = K.SEED) -> GBTRegressor:
    """M18(b): boosted trees whose label is the log residual, so that an output of zero is the persistence forecast."""
    most, rate, depth, leaf, share = settings
    return GBTRegressor(featuresCol="features", labelCol="resid", predictionCol="resid_pred", maxIter=rounds or most, stepSize=rate, maxDepth=depth,
                        minInstancesPerNode=leaf, subsamplingRate=share, maxBins=K.GBT_MAX_BINS, seed=seed)


def loss_history(settings: dict[str, tuple], fit: DataFrame, valid: DataFrame, seed: int = K.SEED) -> DataFrame:
    """Squared loss on the log residual after every round of each named fit, on its own and on the validation rows, as rows
    (model, iteration, train, valid). Iteration 0 is the anchor, a residual of zero everywhere. Both frames hold ``features`` and ``resid``;
    each is cached once for all fits, and only the losses (one pair a round) reach the driver."""
    anchor = F.avg(F.col("resid") * F.col("resid"))
    with kept(fit) as own, kept(valid) as held:
        zero = (own.agg(anchor).first()[0], held.agg(anchor).first()[0])

        def rows(name):
            model = residual_trees(settings[name], seed=seed).fit(own)
            losses = zip(model.evaluateEachIteration(own, "squared"), model.evaluateEachIteration(held, "squared"))
            return [(name, 0, *zero), *((name, i, float(t), float(v)) for i, (t, v) in enumerate(losses, 1))]

        found = parallel_fits([lambda n=n: rows(n) for n in settings])
    return fit.sparkSession.createDataFrame([r for part in found for r in part], HISTORY)


def early_stop_points(history: DataFrame, patience: int = K.STOP_PATIENCE, min_delta: float = K.STOP_MIN_DELTA) -> DataFrame:
    """Per model the round a fit would return and the round it would stop at: a round counts as better when its validation loss is more than
    ``min_delta`` below the best so far, and ``patience`` rounds without a better one end the fit. Round 0 (the anchor) is no candidate.

    The rule is sequential, so a model's losses (one per round, a few hundred) are folded in order inside one expression."""
    losses = F.array_sort(F.collect_list(F.struct("iteration", "valid")))
    start = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("stop"))

    def step(now, row):
        better = now["stop"].isNull() & (now["best"].isNull() | (row["valid"] < now["best"] - F.lit(min_delta)))
        ends = now["stop"].isNull() & ~better & (row["iteration"] - now["at"] >= patience)
        return F.struct(F.when(better, row["valid"]).otherwise(now["best"]).alias("best"), F.when(better, row["iteration"]).otherwise(now["at"]).alias("at"),
                        F.when(ends, row["iteration"]).otherwise(now["stop"]).alias("stop"))

    per = history.where("iteration > 0").groupBy("model").agg(losses.alias("losses"), F.max("iteration").alias("rounds"))
    folded = per.select("model", "rounds", F.aggregate("losses", start, step).alias("f"))
    return folded.select("model", "rounds", F.col("f.at").alias("best_iteration"), F.col("f.best").alias("best_valid"),
                         F.coalesce("f.stop", "rounds").alias("stop_iteration"), F.col("f.stop").isNotNull().alias("stopped_early"))


def overfit_gap(history: DataFrame) -> DataFrame:
    """Per model the lowest validation loss and its round (ties: the first), the last round's losses, and by how much the last
    validation loss lies above the last training loss and above its own minimum."""
    last, least = F.max(F.struct("iteration", "train", "valid")), F.min(F.struct("valid", "iteration"))
    per = history.where("iteration > 0").groupBy("model").agg(last.alias("z"), least.alias("m"))
    return per.select("model", F.col("z.iteration").alias("rounds"), F.col("m.iteration").alias("lowest_iteration"), F.col("m.valid").alias("lowest_valid"),
                      F.col("z.train").alias("final_train"), F.col("z.valid").alias("final_valid"), (F.col("z.valid") - F.col("z.train")).alias("final_gap"),
                      (F.col("z.valid") - F.col("m.valid")).alias("above_lowest"))


def residual_frames(fit: DataFrame, others: list[DataFrame], numeric: list[str], category: str, target: str, base: str) -> list[DataFrame]:
    """Design matrices (``features``, learned from ``fit`` only) with the log residual ``resid`` as label."""
    labelled = [f.withColumn("resid", X.residual_target(target, base)) for f in (fit, *others)]
    return design_matrix(labelled[0], labelled[1:], numeric, category)[1]


def fit_residual_trees(fit: DataFrame, scored: list[DataFrame], settings: tuple, rounds: int, base: str, seed: int = K.SEED):
    """M18(b): the fit of ``residual_trees`` cut at ``rounds`` (every round has its own seed, so the first rounds of a longer fit), and the
    scored frames with prediction = max(expm1(log1p(base) + r), 0)."""
    with kept(fit) as rows:
        model = residual_trees(settings, rounds, seed).fit(rows)
    return model, [model.transform(f).withColumn("prediction", X.residual_reconstruct(base, "resid_pred")) for f in scored]


def save_pipeline(model: PipelineModel, path: str) -> None:
    """K4: persist the fitted feature pipeline next to the design matrices."""
    model.write().overwrite().save(path)
