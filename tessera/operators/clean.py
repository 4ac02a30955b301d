"""Clean a text cube into the typed master table (16 -> 25 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera import contract as K
from tessera.functions.flags import any_true, partial_period, safe_ratio, suppressed
from tessera.functions.parse import count_to_double, lenient_int, strict_date

SUPPRESSED = [f"{m}_suppressed" for m in K.MEASURES]
CLEAN_COLUMNS = (
    K.DATE_COLS + ["grain", "year", "month", "geo", "sex", "band"] + K.MEASURES + ["footnote"]
    + SUPPRESSED + ["has_suppression", "is_partial_period", "a_share_of_total"]
)


def clean(raw: DataFrame) -> DataFrame:
    """P1-P10 as one projection (a single Project node after Catalyst)."""
    df = raw.withColumnsRenamed(K.RENAME)
    df = df.select(
        *[strict_date(c, K.TEXT_DATE_PARSE).alias(c) for c in K.DATE_COLS],
        "grain",
        lenient_int("year").alias("year"),
        lenient_int("month").alias("month"),
        "geo",
        "sex",
        "band",
        *[count_to_double(m).alias(m) for m in K.MEASURES],
        "footnote",
    )
    df = df.select("*", *[suppressed(m).alias(f"{m}_suppressed") for m in K.MEASURES])
    return df.select(
        "*",
        any_true(SUPPRESSED).alias("has_suppression"),
        partial_period().alias("is_partial_period"),
        safe_ratio("a", "total").alias("a_share_of_total"),
    )
