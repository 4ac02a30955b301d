import tempfile

import pytest

from conftest import text_rows

from tessera.contract import SOURCE_HEADER as HEADER
from tessera.sources.text import HeaderContractError, MissingInputError, check_header, read_text_table


def test_missing_input_has_instructions(spark):
    with pytest.raises(MissingInputError, match="materialize"):
        read_text_table(spark, tempfile.mkdtemp() + "/absent.csv")


def test_header_contract(spark):
    check_header(HEADER)
    with pytest.raises(HeaderContractError):
        check_header(HEADER[:-1] + ["Notes"])


def test_renamed_header_fails_on_read(spark):
    out = tempfile.mkdtemp(prefix="tessera-hdr-")
    df = text_rows(spark, [{}])
    df.withColumnRenamed("Geo", "Region").write.mode("overwrite").option("header", True).csv(out + "/x")
    with pytest.raises(Exception):
        read_text_table(spark, out + "/x").collect()


def test_na_tokens_become_null(spark):
    out = tempfile.mkdtemp(prefix="tessera-na-")
    text_rows(spark, [{"A Count": "NA", "Footnote": "null"}]).write.mode("overwrite").option("header", True) \
        .csv(out + "/x")
    r = read_text_table(spark, out + "/x").first()
    assert r["A Count"] is None and r["Footnote"] is None


def test_source_profile(spark):
    import os

    from tessera.sources.store import load_text
    from tessera.sources.text import source_profile

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    prof = source_profile(load_text(spark, sf)).first()
    assert prof.raw_rows == 125307 and prof.raw_columns == 16
    assert prof.source_mb > 0 and prof.source_files >= 1


def test_fingerprint_ignores_order_and_layout_but_not_content(spark):
    from tessera.sources.text import content_fingerprint

    df = spark.createDataFrame([("g", "a", None), ("g", "b", "2"), ("h", "a", "1")], "grp string, x string, y string")
    marks = lambda d: {r.grp: (r["rows"], r.fingerprint) for r in content_fingerprint(d, ["grp"]).collect()}
    want = marks(df)
    assert marks(df.orderBy("x").repartition(3)) == want
    other = marks(df.replace("2", "3"))
    assert other["h"] == want["h"] and other["g"] != want["g"]


def test_new_data_under_the_same_path_is_built_anew(spark, tmp_path):
    import os
    import shutil

    from tessera.sources import store

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    d = tmp_path / "sf"
    d.mkdir()
    for t in store.FACT_TABLES:
        shutil.copy(f"{sf}/{t}.parquet", d / f"{t}.parquet")
    first = store.materialize(spark, str(d))
    assert store.materialize(spark, str(d)) == first
    spark.read.parquet(f"{sf}/lineitem.parquet").limit(100).coalesce(1).write.mode("overwrite").parquet(str(d / "lineitem.parquet"))
    second = store.materialize(spark, str(d))
    assert second != first
    store.release(spark, str(d))
    assert not os.path.exists(second["root"].removeprefix("file:"))
