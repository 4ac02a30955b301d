import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from conftest import text_rows
from tessera.operators.clean import CLEAN_COLUMNS, clean
from tessera.operators import quality as Q


def test_counts_and_suppression(spark):
    df = clean(text_rows(spark, [
        {"A Count": "1,234", "Footnote": None},
        {"A Count": "abc", "Footnote": None},
        {"A Count": None, "Footnote": "suppressed"},
        {"A Count": None, "Footnote": None},
        {"A Count": "0", "Total Count": None, "Footnote": "suppressed"},
    ])).collect()
    assert [r.a for r in df] == [1234.0, None, None, None, 0.0]
    assert [r.a_suppressed for r in df] == [False, False, True, False, False]
    assert df[4].total_suppressed and df[4].has_suppression
    assert len(df[0]) == 25 and list(df[0].asDict()) == CLEAN_COLUMNS


@pytest.mark.parametrize("bad", ["2020-13-01", "13/45/2020"])
def test_malformed_date_raises(spark, bad):
    with pytest.raises((PySparkException, Py4JJavaError)):
        clean(text_rows(spark, [{"Start Date": bad}])).collect()


def test_lenient_year(spark):
    r = clean(text_rows(spark, [{"Year": "abc"}])).first()
    assert r.year is None


def test_key_duplicates_with_null_keys(spark):
    row = {"Group": "By Total", "Year": None, "Month": None}
    raw = text_rows(spark, [row, row, {"Geo": "G2"}])
    out = Q.duplicate_audit(raw).first()
    assert out.key_duplicates == 1 and out.exact_duplicates == 1
    # count_distinct over keys would drop the null-key rows entirely
    from pyspark.sql import functions as F

    assert raw.select(F.count_distinct("Group", "Year", "Month")).first()[0] == 1


def test_safe_share(spark):
    rows = clean(text_rows(spark, [
        {"Total Count": "0"}, {"Total Count": None}, {"Total Count": "10", "A Count": None},
        {"Total Count": "10", "A Count": "4"},
    ])).collect()
    assert [r.a_share_of_total for r in rows] == [None, None, None, 0.4]


def test_partial_period(spark):
    rows = clean(text_rows(spark, [
        {"Start Date": "01/01/2020", "End Date": "01/31/2020"},
        {"Start Date": "01/01/2020", "End Date": "01/30/2020"},
        {"Start Date": "02/01/2020", "End Date": "02/29/2020", "Month": "2"},
        {"Group": "By Year", "Month": None, "Start Date": "01/01/2021", "End Date": "12/30/2021", "Year": "2021"},
        {"Group": "By Year", "Month": None, "Start Date": "01/01/2021", "End Date": "12/31/2021", "Year": "2021"},
        {"Group": "By Total", "Year": None, "Month": None, "End Date": "05/05/2021"},
    ])).collect()
    assert [r.is_partial_period for r in rows] == [False, True, False, True, False, False]


def test_rule_audit_edges(spark):
    rows = text_rows(spark, [
        # start > end and end > as_of on one row: counted twice
        {"Start Date": "03/01/2024", "End Date": "02/01/2024", "Data As Of": "01/01/2024"},
        # union < max(components) with one component null
        {"A Count": None, "B Count": "7", "C Count": "2", "A, B, or C Count": "5", "Footnote": "x"},
        # union null: not counted
        {"A, B, or C Count": None, "Footnote": "x"},
        {"A Count": "-1"},
    ])
    out = Q.rule_audit(clean(rows)).first()
    assert out.invalid_dates == 2
    assert out.union_lt_components == 1
    assert out.negative_counts == 1


def test_lenient_year_numeric_forms(spark):
    rows = clean(text_rows(spark, [{"Year": "2020"}, {"Year": "2020.0"}, {"Year": "2.02e3"}, {"Year": "2020.5"},
                                   {"Year": " 2021 "}])).collect()
    assert [r.year for r in rows] == [2020, 2020, 2020, None, 2021]


def test_single_digit_month_and_day_parse(spark):
    r = clean(text_rows(spark, [{"Start Date": "1/5/2020", "End Date": "1/31/2020"}])).first()
    assert str(r.start_date) == "2020-01-05" and str(r.end_date) == "2020-01-31"


def test_malformed_date_raises_without_ansi(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises((PySparkException, Py4JJavaError)):
            clean(text_rows(spark, [{"End Date": "02/30/2020"}])).collect()
        # lenient parts stay lenient
        assert clean(text_rows(spark, [{"A Count": "x1"}])).first().a is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
