"""Published figures recomputed by the operators, and the audit that must raise."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import describe as D
from tessera.operators import quality as Q

#: The published national band table (count, total), in age order.
BANDS = [
    (519, 73213), (285, 14299), (509, 22008), (3021, 133459),
]


def test_published_shares_of_the_youngest_bands(spark):
    """The published percentages follow from the published counts (1,146,774 in all bands)."""
    rest = 1_146_774 - sum(a for a, _ in BANDS)
    rows = [(k, float(a), float(t), "s") for k, (a, t) in enumerate(BANDS)] + [(9, float(rest), 1.0, "s")]
    df = spark.createDataFrame(rows, "band int, a double, total double, slice string")
    out = {r.band: r for r in D.share_of_slice(df, "a", ["slice"], "share").withColumn("pct", 100 * F.col("a") / F.col("total")).collect()}
    assert [round(out[k].share, 9) for k in range(4)] == [0.045257392, 0.024852325, 0.04438538, 0.263434644]
    assert [round(out[k].pct, 9) for k in range(4)] == [0.708890498, 1.993146374, 2.312795347, 2.263616541]
    assert sum(r.share for r in out.values()) == pytest.approx(100)


def test_published_fence(spark):
    """Quartiles 5763.75 and 27740.5 of 52 values give the published fence 60705.625."""
    values = [0.0] * 12 + [5761.0, 5764.666667] + [10000.0] * 24 + [27740.0, 27742.0] + [30000.0] * 9 + [70000.0] * 3
    df = spark.createDataFrame([(v, "s") for v in values], "v double, s string")
    row = D.iqr_bounds(df, "v", ["s"]).first()
    assert len(values) == 52 and row.q1 == pytest.approx(5763.75, abs=1e-3) and row.q3 == pytest.approx(27740.5)
    assert row.fence == pytest.approx(60705.625, abs=1e-2)
    assert D.iqr_flags(df, "v", ["s"]).where("iqr_flag").count() == 3


def test_audit_raises_with_every_failure(spark):
    from conftest import text_rows
    from tessera.operators.clean import clean

    good = text_rows(spark, [{}, {"Geo": "G2"}])
    assert set(Q.assert_audit(clean(good), good).values()) == {0}
    bad = text_rows(spark, [{"A Count": "20", "Total Count": "10"}, {"Start Date": "04/30/1998", "End Date": "04/01/1998", "Month": "4"},
                            {"Geo": "G9"}, {"Geo": "G9"}])
    with pytest.raises(AssertionError) as failed:
        Q.assert_audit(clean(bad), bad)
    for rule in ("a_gt_total", "union_lt_components", "invalid_dates", "exact_duplicates", "key_duplicates"):
        assert rule in str(failed.value)


def test_duplicate_audit_counts_null_keys(spark):
    raw = spark.createDataFrame([("k", None, 1), ("k", None, 1), ("k", None, 2), (None, None, 3), (None, None, 4), ("z", "y", 5)], "a string, b string, v int")
    row = Q.duplicate_audit(raw, ["a", "b"]).first()
    assert (row.exact_duplicates, row.key_duplicates) == (1, 3)
