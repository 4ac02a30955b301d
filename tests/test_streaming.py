import os
import shutil
import tempfile

import pytest
from conftest import text_rows

SF = "/root/testdata/sf0.001"


def _extract(spark, df, folder, name):
    tmp = tempfile.mkdtemp(prefix="tessera-extract-")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp)
    part = next(f for f in os.listdir(tmp) if f.startswith("part-") and f.endswith(".csv"))
    shutil.copy(f"{tmp}/{part}", f"{folder}/{name}.csv")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_ingest_matches_batch_clean(spark):
    from tessera.sources.store import load_clean, materialize
    from tessera.streaming.ingest import ingest_extracts

    src = materialize(spark, SF)["text"]
    out = tempfile.mkdtemp(prefix="tessera-ingest-")
    ingest_extracts(spark, src, out, max_files=4)
    got = spark.read.parquet(out + "/clean")
    want = load_clean(spark, SF)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert spark.read.parquet(out + "/audit").agg({"negative_counts": "sum"}).first()[0] == 0
    assert spark.read.parquet(out + "/files").agg({"count": "sum"}).first()[0] == want.count()


def test_swapped_columns_fail(spark):
    from tessera.streaming.ingest import ingest_extracts

    src, out = tempfile.mkdtemp(prefix="tessera-src-"), tempfile.mkdtemp(prefix="tessera-out-")
    rows = text_rows(spark, [{"A Count": "1", "B Count": "2"}])
    swapped = [{"A Count": "B Count", "B Count": "A Count"}.get(c, c) for c in rows.columns]
    _extract(spark, rows.select(*[f"`{c}`" for c in swapped]), src, "swapped")
    with pytest.raises(Exception, match="(?i)header"):
        ingest_extracts(spark, src, out)
    assert not [f for _, _, files in os.walk(out) for f in files if f.startswith("part-")]  # not one row was written


def test_each_pair_has_its_own_checkpoint(spark):
    from tessera.streaming.ingest import ingest_extracts

    rows = text_rows(spark, [{"A Count": "11"}])
    outs = []
    for k in range(2):
        src = tempfile.mkdtemp(prefix="tessera-src-")
        outs.append(tempfile.mkdtemp(prefix="tessera-out-"))
        _extract(spark, rows, src, f"extract{k}")
        ingest_extracts(spark, src, outs[k])
        files = spark.read.parquet(outs[k] + "/files").collect()
        assert len(files) == 1 and files[0]["source_file"].endswith(f"extract{k}.csv") and files[0]["batch"] == 0
    assert all(spark.read.parquet(o + "/clean").count() == 1 for o in outs)
