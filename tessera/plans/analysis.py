"""End-to-end analysis run: every registered result as a table, and a summary document in two stages.

    python -m tessera.plans.analysis --sf-dir /root/testdata/sf0.01 --out /path/to/results

The run first asserts the audit, then writes one CSV table per key of ``TABLES`` (K1). The summary is a nested document with
one section per key of ``SUMMARY``: the rows of that registered query, under the query's own column names. Its schema
follows from those queries, is written down beside the document, and is what the reader declares. Stage 1 stores the descriptive
sections; stage 2 reads that file back with the declared schema, adds the model sections and stores the whole (K2, S5).
The design matrices and the fitted pipeline, scaler included, are stored for scoring (K4). The clean table is the one the
queries read (K3).

Only the summary's rows - fixed-size results - reach the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import contract as K
from tessera.operators import models as M
from tessera.operators import panel as P
from tessera.operators import quality as Q
from tessera.operators.slices import assert_single_level, grain_slice
from tessera.plans.catalog import MEASURE, QUERIES
from tessera.plans.modelling import MODEL_QUERIES
from tessera.sources.store import load_clean, load_text, materialize

#: query -> order of its table
TABLES = {
    "missingness": ["field"], "age_profile": ["ordinal"], "geo_share": [F.desc("a_pct_total"), F.col("geo")],
    "group_profile": ["grp"], "findings": ["finding"], "forecast_monthly": ["start_date"],
}
MODEL_TABLES = {
    "kmeans_sweep": ["k"], "kmeans_final": ["geo"], "hierarchy_by_cluster": ["hier", "cluster"], "gbt_forecast": ["geo", "start_date"],
    "gbt_cv": ["fold"], "residual_linear": ["geo", "start_date"], "forecast_monthly_models": ["start_date"],
}
SUMMARY = ("source_profile", "quality_summary", "quality_outcomes", "missingness", "iqr_bounds", "national_totals", "extremes", "headline_values",
           "senior_share", "geo_share_stats", "spearman_matrix", "time_splits", "baseline_metrics", "worst_errors")
MODEL_SUMMARY = ("kmeans_sweep", "kmeans_checks", "hierarchy_by_cluster", "gbt_cv", "gbt_metrics", "gbt_early_stopping")


def write_table(df: DataFrame, path: str, order: list | None = None) -> None:
    """K1: CSV with header; a directory of part files, globally ordered when
    ``order`` is given (range-partitioned sort, no single-task funnel)."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).csv(path)


def _sections(spark: SparkSession, sf_dir: str, names) -> tuple[T.StructType, dict]:
    """The schema and rows of a document with one section per query."""
    queries = {**QUERIES, **MODEL_QUERIES}
    fields, rows = [], {}
    for name in names:
        df = queries[name](spark, sf_dir)
        fields.append(T.StructField(name, T.ArrayType(df.schema)))
        rows[name] = df.collect()
    return T.StructType(fields), rows


def write_summary(spark: SparkSession, schema: T.StructType, doc: dict, path: str) -> None:
    """K2: a one-row JSON document, and its schema beside it."""
    row = spark.createDataFrame([tuple(doc[f.name] for f in schema.fields)], schema)
    row.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    spark.createDataFrame([(schema.json(),)], "schema string").write.mode("overwrite").text(f"{path}_schema")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The document under its declared schema; a field of another type fails."""
    declared = T.StructType.fromJson(json.loads(spark.read.text(f"{path}_schema").first()[0]))
    return spark.read.schema(declared).option("mode", "FAILFAST").json(path)


def _write_tables(spark: SparkSession, sf_dir: str, out: str, tables: dict) -> None:
    for name, order in tables.items():
        write_table({**QUERIES, **MODEL_QUERIES}[name](spark, sf_dir), f"{out}/tables/{name}", order)


def write_design(spark: SparkSession, sf_dir: str, out: str) -> int:
    """K4: train and test design matrices and the pipeline that made them; E8: the number of features."""
    panel = P.tag_split(P.lag_panel(load_clean(spark, sf_dir), MEASURE))
    train, test = (panel.filter(F.col("split") == s) for s in ("train", "test"))
    pipeline, (x_train, x_test) = M.design_matrix(train, [test], P.numeric_features(MEASURE), "geo")
    for name, x, label in (("train", x_train, F.log1p(MEASURE)), ("test", x_test, F.col(MEASURE))):
        x.select("geo", "start_date", "features", label.alias("label")).write.mode("overwrite").parquet(f"{out}/design/{name}")
    M.save_pipeline(pipeline, f"{out}/design/pipeline")
    return M.vector_size(x_train)


def run_analysis(spark: SparkSession, sf_dir: str, out: str, with_models: bool = True) -> DataFrame:
    out = out.rstrip("/")
    materialize(spark, sf_dir)
    clean = load_clean(spark, sf_dir)
    Q.assert_audit(clean, load_text(spark, sf_dir))  # A15: raises with every failed rule
    # R2: what is summed holds one level of every dimension
    assert_single_level(grain_slice(clean, K.GRAIN_MONTH, geo=K.GEO_ALL, sex=K.SEX_ALL, band=K.BAND_ALL))
    assert_single_level(grain_slice(clean, K.GRAIN_TOTAL, sex=K.SEX_ALL, band=K.BAND_ALL), ("grain", "sex", "band"))
    _write_tables(spark, sf_dir, out, TABLES)
    schema, doc = _sections(spark, sf_dir, SUMMARY)
    write_summary(spark, schema, doc, f"{out}/summary_stage1")
    if not with_models:
        return read_summary(spark, f"{out}/summary_stage1")
    _write_tables(spark, sf_dir, out, MODEL_TABLES)
    n_features = write_design(spark, sf_dir, out)
    stage1 = read_summary(spark, f"{out}/summary_stage1")
    more, model_doc = _sections(spark, sf_dir, MODEL_SUMMARY)
    whole = T.StructType([*stage1.schema.fields, *more.fields, T.StructField("n_features", T.IntegerType())])
    write_summary(spark, whole, {**stage1.first().asDict(), **model_doc, "n_features": n_features}, f"{out}/summary")
    return read_summary(spark, f"{out}/summary")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--no-models", action="store_true")
    a = ap.parse_args(argv)
    from tessera.session import local_session

    spark = SparkSession.getActiveSession() or local_session()
    run_analysis(spark, a.sf_dir, a.out, not a.no_models).show(vertical=True, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
