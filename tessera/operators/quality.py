"""Data-quality audit (A1-A16), each as one fused aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.session import delete_path


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def quality_summary(clean: DataFrame) -> DataFrame:
    """A1, A3, A6, A14 and the grain counts in one aggregate (one scan)."""
    return clean.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.min("data_as_of").alias("data_as_of"),
        F.min("start_date").alias("start_min"),
        F.max("end_date").alias("end_max"),
        F.count_distinct("geo").cast("bigint").alias("n_geos"),
        F.count_distinct("sex").cast("bigint").alias("n_sexes"),
        F.count_distinct("band").cast("bigint").alias("n_bands"),
        F.count("footnote").cast("bigint").alias("footnoted_rows"),
        _count_if(F.col("footnote").isNull()).alias("fully_observed_rows"),
        _count_if(F.col("is_partial_period")).alias("partial_period_rows"),
        _count_if(F.col("grain") == K.GRAIN_MONTH).alias("month_rows"),
        _count_if(F.col("grain") == K.GRAIN_YEAR).alias("year_rows"),
        _count_if(F.col("grain") == K.GRAIN_TOTAL).alias("total_rows"),
    )


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """A2: frequency table, descending, ties by value (nulls kept if dropna=False)."""
    src = df if not dropna else df.filter(F.col(column).isNotNull())
    return (
        src.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .select(F.lit(column).alias("field"), "value", "n")
        .orderBy(F.desc("n"), F.asc_nulls_first("value"))
    )


def duplicate_audit(raw: DataFrame, key_cols=K.SOURCE_KEY_HEADER) -> DataFrame:
    """A4 + A5: exact duplicate rows and duplicate grain keys, one scan.

    Rows are dealt once by the key columns. That places equal rows and equal
    keys together, so both aggregates (every column, then the keys) run
    without another wide shuffle. Key duplicates are sum(n-1) over
    groupBy(keys): groupBy keeps null keys as a group, unlike
    count_distinct(k1, k2, ...) which drops them.
    """
    by_key = raw.repartition(*[F.col(f"`{c}`") for c in key_cols])
    exact = by_key.groupBy(*[F.col(f"`{c}`") for c in raw.columns]).agg(F.count(F.lit(1)).alias("n"))
    keys = exact.groupBy(*[F.col(f"`{c}`") for c in key_cols]).agg(
        F.sum(F.col("n") - 1).alias("exact_dup"), F.sum("n").alias("n"))
    return keys.agg(
        F.coalesce(F.sum("exact_dup"), F.lit(0)).cast("bigint").alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("key_duplicates"),
    )


def missingness(clean: DataFrame, columns=K.MEASURES) -> DataFrame:
    """Missing count and percent per column, long form, one scan."""
    n = F.count(F.lit(1))
    wide = clean.agg(
        n.alias("__n"),
        *[_count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.select(
        "__n", F.expr(f"stack({len(columns)}, {stack}) AS (field, missing_count)")
    ).select(
        "field",
        F.col("missing_count").cast("bigint").alias("missing_count"),
        F.try_divide(F.lit(100.0) * F.col("missing_count"), F.col("__n")).alias("missing_percent"),
    )


def rule_columns() -> list[Column]:
    """A9-A13 as aggregates; a null comparison never counts."""
    a, total, b, ov, c, u = (F.col(x) for x in K.MEASURES)
    neg = sum((_count_if(F.col(m) < 0) for m in K.MEASURES), F.lit(0).cast("bigint"))
    return [
        neg.alias("negative_counts"),
        _count_if(a > total).alias("a_gt_total"),
        _count_if(b > total).alias("b_gt_total"),
        _count_if(c > total).alias("c_gt_total"),
        _count_if(ov > a).alias("overlap_gt_a"),
        _count_if(ov > b).alias("overlap_gt_b"),
        _count_if(u < F.greatest(a, b, c)).alias("union_lt_components"),
        (_count_if(F.col("start_date") > F.col("end_date"))
         + _count_if(F.col("end_date") > F.col("data_as_of"))).alias("invalid_dates"),
    ]


def rule_audit(clean: DataFrame) -> DataFrame:
    """Rule counters, one scan."""
    return clean.agg(*rule_columns())


def write_audited(rows: DataFrame, path: str, partition_by: list[str] = ()) -> dict:
    """A9-A15 in flight: write ``rows`` as Parquet and count the rule violations on the way, without a scan of their own. A violated
    rule undoes the write and raises with the list of all failures; else the counters are returned."""
    audit = Observation("rule-audit")
    rows.observe(audit, F.count(F.lit(1)).alias("rows"), *rule_columns()).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    counts = {k: v or 0 for k, v in audit.get.items()}
    failed = {k: v for k, v in counts.items() if v and k != "rows"}
    if failed:
        delete_path(rows.sparkSession, path)
        raise AssertionError(f"audit failed: {failed}")
    return counts


def assert_audit(clean: DataFrame, raw: DataFrame | None = None) -> dict:
    """Evaluate every rule in one pass and raise listing *all* failures."""
    row = rule_audit(clean).first().asDict()
    if raw is not None:
        row.update(duplicate_audit(raw).first().asDict())
    failed = {k: v for k, v in row.items() if v}
    if failed:
        raise AssertionError(f"audit failed: {failed}")
    return row


def band_reconcile(clean: DataFrame, measure: str = "total", geo: str = K.GEO_ALL) -> DataFrame:
    """Exclusive bands must sum to the All Bands row of the same cell.

    One conditional aggregate per (grain, start_date, geo, sex) group: no join.
    """
    m = F.col(measure)
    excl = F.col("band").isin(K.EXCLUSIVE_BAND_LABELS)
    return (
        clean.filter((F.col("geo") == geo) & (excl | (F.col("band") == K.BAND_ALL)))
        .groupBy("grain", "start_date", "geo", "sex")
        .agg(
            F.sum(F.when(excl, m)).alias("bands_sum"),
            F.max(F.when(F.col("band") == K.BAND_ALL, m)).alias("all_value"),
        )
        .withColumn("diff", F.col("all_value") - F.col("bands_sum"))
    )
