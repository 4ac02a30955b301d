"""Level contract, audit in flight, snapshot diff, mergeable sketches and the streaming monitor."""

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.operators import describe as D
from tessera.operators import quality as Q
from tessera.operators import sketches as SK
from tessera.operators import slices as S
from tessera.sources import snapshot as SN
from tessera.streaming import monitor as MO

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- levels

@pytest.fixture(scope="module")
def cells(spark):
    rows = [(g, geo, sex, band, 1.0, 2.0) for g in K.GRAINS for geo in ("X", K.GEO_ALL) for sex in K.SEXES for band in K.ALL_BAND_LABELS]
    return spark.createDataFrame(rows, "grain string, geo string, sex string, band string, a double, total double")


def test_single_levels_and_parts_may_be_added(cells):
    one = S.grain_slice(cells, K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEX_ALL, band=K.BAND_ALL)
    assert S.require_levels(one) is one
    S.require_levels(S.grain_slice(cells, K.GRAIN_TOTAL, K.GEO_ALL, K.SEX_PARTS, K.EXCLUSIVE_BAND_LABELS))
    S.require_levels(S.in_domain(S.grain_slice(cells, K.GRAIN_YEAR, sex=K.SEX_ALL, band=K.SENIOR_BANDS)))
    S.require_levels(S.grain_slice(cells, K.GRAIN_TOTAL, sex=K.SEX_ALL, band=K.BAND_ALL), by=["geo"])
    kept = one.select(F.lit(1).alias("x"), "a").where("a > 0")  # the note travels with the measure
    assert S.mixed_levels(kept, "a") == {}


@pytest.mark.parametrize("slice_of, by, offending", [
    (dict(grain=K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEX_ALL), (), {"band"}),
    (dict(grain=K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEXES, band=K.BAND_ALL), (), {"sex"}),
    (dict(grain=K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEX_ALL, band=[K.BAND_ALL, "5-9"]), (), {"band"}),
    (dict(grain=K.GRAIN_TOTAL, geo=K.GEO_ALL, sex=K.SEX_ALL, band=[b[0] for b in K.OVERLAP_BANDS]), (), {"band"}),
    (dict(grain=[K.GRAIN_YEAR, K.GRAIN_MONTH], sex=K.SEX_ALL, band=K.BAND_ALL), (), {"grain", "geo"}),
    (dict(grain=K.GRAIN_TOTAL, band=K.BAND_ALL), ("geo",), {"sex"}),
])
def test_mixed_levels_fail_without_a_job(spark, cells, slice_of, by, offending):
    df = S.grain_slice(cells, **slice_of)
    spark.sparkContext.setJobGroup("levels", "plan time only")
    assert set(S.mixed_levels(df, "a", by)) == offending
    with pytest.raises(S.LevelError, match="mixes levels"):
        S.require_levels(df, "a", by)
    with pytest.raises(S.LevelError):
        D.share_of_slice(df, "a", list(by) or ["geo"], "s") if "geo" not in offending else D.share_of_slice(df, "a", [], "s")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("levels")
    spark.sparkContext.setJobGroup("", "")


def test_slices_still_push_their_filters(spark, tmp_path, cells):
    cells.write.partitionBy("grain").parquet(str(tmp_path / "c"))
    df = S.in_domain(S.grain_slice(spark.read.parquet(str(tmp_path / "c")), K.GRAIN_TOTAL, sex=K.SEX_ALL, band=K.BAND_ALL)).select("a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in plan and "EqualTo(sex,All)" in plan and "ReadSchema: struct<geo:string,sex:string,band:string,a:double>" in plan


# ---------------------------------------------------------------- audit in flight

def audited_rows(spark, **change):
    day = datetime.date(1998, 1, 1)
    plain = dict(a=3.0, total=9.0, b=2.0, overlap=1.0, c=1.0, union_cnt=5.0, start_date=day, end_date=day, data_as_of=day, grain="g")
    types = "a double, total double, b double, overlap double, c double, union_cnt double, start_date date, end_date date, data_as_of date, grain string"
    return spark.createDataFrame([tuple(plain.values()), tuple((plain | change).values())], types)


def test_clean_rows_are_written_and_counted_in_one_job(spark, tmp_path):
    rows = audited_rows(spark, a=None)
    spark.sparkContext.setJobGroup("audited", "one write")
    counts = Q.write_audited(rows, str(tmp_path / "out"), ["grain"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("audited")) == 1
    spark.sparkContext.setJobGroup("", "")
    assert counts["rows"] == 2 and not any(v for k, v in counts.items() if k != "rows")
    assert {k: v for k, v in counts.items() if k != "rows"} == Q.rule_audit(rows).first().asDict()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert Q.write_audited(rows.limit(0), str(tmp_path / "none"))["rows"] == 0


def test_a_violated_rule_undoes_the_write(spark, tmp_path):
    late = datetime.date(1999, 1, 1)
    with pytest.raises(AssertionError, match=r"a_gt_total.*invalid_dates|invalid_dates.*a_gt_total"):
        Q.write_audited(audited_rows(spark, a=10.0, start_date=late), str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out")


# ---------------------------------------------------------------- snapshots

SNAP = "s string, t string, k int, v double, note string"


def extract(spark, edits=()):
    rows = {(s, t, k): (float(k), None if k % 3 else "n") for s in ("a b", "c%:/", "d") for t in ("1", "2") for k in range(8)}
    for key, value in edits:
        if value is None:
            rows.pop(key)
        else:
            rows[key] = value
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SNAP).repartition(3)


EDITS = [(("a b", "1", 3), (99.0, None)), (("a b", "1", 0), (0.0, None)), (("d", "2", 5), None), (("d", "2", 50), (5.0, None)), (("e", "1", 1), (1.0, None)),
         *((("c%:/", "2", k), None) for k in range(8))]


def test_planted_edits_are_found_exactly(spark):
    old, new = extract(spark), extract(spark, EDITS).select("note", "v", "k", "t", "s")  # columns in any order
    got = {tuple(r[:3]): r["change"] for r in SN.cell_changes(old, new, ["s", "t"], ["s", "t", "k"]).collect()}
    want = {("a b", "1", "3"): "changed", ("a b", "1", "0"): "changed", ("d", "2", "5"): "removed", ("d", "2", "50"): "added", ("e", "1", "1"): "added",
            **{("c%:/", "2", str(k)): "removed" for k in range(8)}}
    assert got == want
    assert SN.cell_changes(old, old.repartition(5), ["s", "t"], ["s", "t", "k"]).count() == 0


def files_of(root):
    return {f[len(root):] for f in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def test_publishing_rewrites_changed_slices_only(spark, tmp_path):
    root = str(tmp_path / "table")
    first = {tuple(r) for r in SN.publish(spark, extract(spark), root, ["s", "t"]).collect()}
    assert len(first) == 6 and {c for *_, c in first} == {"added"}
    before = files_of(root)
    changes = {tuple(r[:2]): r["change"] for r in SN.publish(spark, extract(spark, EDITS), root, ["s", "t"]).collect()}
    assert changes == {("a b", "1"): "changed", ("d", "2"): "changed", ("e", "1"): "added", ("c%:/", "2"): "removed"}
    kept = {f for f in before if "/s=a b/t=1/" not in f and "/s=d/t=2/" not in f and not ("c%" in f and "/t=2/" in f)}
    after = files_of(root)
    assert kept <= after and not (before - kept) & after
    read = spark.read.parquet(f"{root}/data").select(F.col("s"), F.col("t").cast("string").alias("t"), "k", "v", "note")
    want = extract(spark, EDITS)
    assert read.exceptAll(want).count() == 0 and want.exceptAll(read).count() == 0
    assert SN.publish(spark, extract(spark, EDITS), root, ["s", "t"]).count() == 0 and files_of(root) == after


# ---------------------------------------------------------------- sketches

def test_merged_sketches_stay_within_their_bound(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS batch", "id % 20011 AS x", "CAST(id % 13 AS STRING) AS y", "CAST(NULL AS INT) AS z")
    s = SK.batch_sketches(df, ["batch"], ["x", "y", "z"]).persist()
    assert {r["exact"] for r in s.where("field = 'y'").collect()} == {13}
    got = {r["field"]: r for r in SK.merged_counts(s).collect()}
    assert abs(got["x"]["estimate"] - 20011) <= SK.BOUND * 20011 and got["y"]["estimate"] == 13 and got["z"]["estimate"] == 0
    assert (got["x"]["batches"], got["x"]["rows"], got["z"]["rows"]) == (7, 60_000, 0)
    parts = [SK.merged_counts(s.where(c)).count() for c in ("batch < 3", "batch >= 3")]  # any split of the batches merges
    assert parts == [3, 3]
    s.unpersist()


# ---------------------------------------------------------------- streaming monitor

def score_rows(rng):
    rows = []
    for m in range(8):
        for g in "abc":
            actual = float(rng.randrange(5, 90))
            rows.append((g, datetime.date(2000, m + 1, 1), 1, actual, actual + rng.randrange(-9, 9), actual + rng.randrange(-6, 6)))
    return rows


def test_monitor_does_not_depend_on_arrival(spark, tmp_path):
    rng = random.Random(6)
    rows = score_rows(rng)
    corrected = [(g, d, 2, a, p + 40, b) for g, d, _, a, p, b in rows[:5]]
    want = MO.rolling_wape(MO.latest_scores(spark.createDataFrame(rows + corrected, MO.SCORES))).orderBy("start_date").collect()
    batch = MO.rolling_wape(spark.createDataFrame(corrected + rows[5:], MO.SCORES)).orderBy("start_date").collect()
    assert [tuple(r) for r in batch] == [tuple(r) for r in want] and any(r["suspend"] for r in want)
    for order in range(2):
        src, out = str(tmp_path / f"in{order}"), str(tmp_path / f"out{order}")
        files = [corrected, rows[:9], rows[9:], rows[3:6]]  # corrections first, months split, rows repeated
        rng.shuffle(files)
        for half in (files[:2], files[2:]):  # a second start goes on from the checkpoint
            for part in half:
                spark.createDataFrame(part, MO.SCORES).coalesce(1).write.mode("append").parquet(src)
            MO.monitor_scores(spark, src, out)
        got = MO.rolling_wape(MO.read_cells(spark, out)).orderBy("start_date").collect()
        assert [r["start_date"] for r in got] == [r["start_date"] for r in want]
        for g, w in zip(got, want):
            assert (g["wape_2m"], g["base_wape_2m"], g["suspend"]) == (pytest.approx(w["wape_2m"]), pytest.approx(w["base_wape_2m"]), w["suspend"])
        batches = len(glob.glob(f"{out}/cells/batch=*"))
        MO.monitor_scores(spark, src, out)  # nothing new: nothing written
        assert len(glob.glob(f"{out}/cells/batch=*")) == batches >= 4
