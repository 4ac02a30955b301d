import os
import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_whole_run_with_models(spark):
    from tessera.operators import panel as P
    from tessera.plans import analysis as A
    from tessera.plans.catalog import MEASURE
    from tessera.sources.store import load_clean

    out = tempfile.mkdtemp(prefix="tessera-analysis-")
    doc = A.run_analysis(spark, SF, out).first()
    assert doc["source_profile"][0]["raw_rows"] == doc["quality_summary"][0]["rows"] == 125307
    assert all(r["passed"] for r in doc["quality_outcomes"])
    assert [r["k"] for r in doc["kmeans_sweep"]] == list(range(2, 9))
    assert all(r["all_groups_used"] and r["cost_is_inertia"] and r["in_order"] for r in doc["kmeans_checks"])
    assert sum(r["n"] for r in doc["hierarchy_by_cluster"]) == 25
    stage1 = A.read_summary(spark, f"{out}/summary_stage1")
    assert stage1.columns == list(A.SUMMARY) and stage1.first()["extremes"] == doc["extremes"]
    for name in [*A.TABLES, *A.MODEL_TABLES]:
        assert spark.read.option("header", True).csv(f"{out}/tables/{name}").count() > 0
    # the stored pipeline, scaler included, scores raw rows like the stored design matrix
    rows = P.tag_split(P.lag_panel(load_clean(spark, SF), MEASURE)).where("split = 'test'")
    again = PipelineModel.load(f"{out}/design/pipeline").transform(rows).select("geo", "start_date", F.col("features").alias("f"))
    both = again.join(spark.read.parquet(f"{out}/design/test"), ["geo", "start_date"])
    assert both.count() == rows.count() and all(r.f == r.features for r in both.collect())
    assert len(both.first().f) == doc["n_features"]
