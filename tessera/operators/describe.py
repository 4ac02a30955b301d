"""Descriptive aggregates over grain-safe slices.

Whole-slice statistics attached to rows (J6) are computed as a slice-keyed
aggregate and joined back on the slice keys, so many slices are handled in
one pass. That aggregate has one row per slice; it is broadcast after a count
proves it small, so rows that share one slice key are never shuffled to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.functions.flags import pct
from tessera.operators.ranks import exact_quantiles, rank_correlations
from tessera.operators.slices import require_levels, sliced
from tessera.session import bounded_broadcast

MAX_SLICES = 10_000


def quantiles(df: DataFrame, value: str, probs=(0.25, 0.75), by: list[str] | None = None) -> DataFrame:
    """G1: exact quantiles with linear interpolation (pandas/numpy default); no slice is gathered."""
    return exact_quantiles(df, value, probs, by)


def iqr_bounds(df: DataFrame, value: str, by: list[str] | None = None, k: float = 1.5) -> DataFrame:
    q = quantiles(df, value, (0.25, 0.75), by)
    return q.select(
        *(by or []),
        F.col("q25").alias("q1"),
        F.col("q75").alias("q3"),
        (F.col("q75") - F.col("q25")).alias("iqr"),
        (F.col("q75") + F.lit(k) * (F.col("q75") - F.col("q25"))).alias("fence"),
    )


def iqr_flags(df: DataFrame, value: str, by: list[str], k: float = 1.5) -> DataFrame:
    """Flag values above the upper fence of their slice (join back on keys)."""
    bounds = bounded_broadcast(iqr_bounds(df, value, by, k), MAX_SLICES)
    return df.join(bounds, by, "inner").withColumn("iqr_flag", F.col(value) > F.col("fence"))


def share_of_slice(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """100*value/sum(value) within the slice identified by ``by``."""
    if sliced(df, value):
        require_levels(df, value, by)
    tot = bounded_broadcast(df.groupBy(*by).agg(F.sum(value).alias("__slice_sum")), MAX_SLICES)
    return df.join(tot, by, "inner").withColumn(name, pct(value, "__slice_sum")).drop("__slice_sum")


def min_count_sum(df: DataFrame, value: str, by: list[str], min_count: int, name: str) -> DataFrame:
    """Sum that is null unless at least ``min_count`` values are present."""
    if sliced(df, value):
        require_levels(df, value, by)
    return df.groupBy(*by).agg(
        F.when(F.count(value) >= min_count, F.sum(value)).alias(name),
        F.count(value).cast("bigint").alias("n_obs"),
    )


def arg_max(value: Column, key: Column) -> Column:
    """``key`` of the largest non-null ``value``; ties -> smallest key."""
    return F.min(F.when(value.isNotNull(), F.struct((-value).alias("v"), key.alias("k"))))["k"]


def arg_min(value: Column, key: Column) -> Column:
    """``key`` of the smallest non-null ``value``; ties -> smallest key."""
    return F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), key.alias("k"))))["k"]


def guarded_pivot(df: DataFrame, index: list[str], column: str, values: list[str], value: str,
                  prefix: str = "") -> DataFrame:
    """Pivot with explicit values; a duplicated cell raises instead of
    silently picking one (pandas semantics)."""
    agg = (
        df.filter(F.col(column).isin(values))
        .groupBy(*index)
        .pivot(column, values)
        .agg(F.first(value).alias("v"), F.count(F.lit(1)).alias("n"))
    )
    worst = F.greatest(*[F.col(f"{v}_n") for v in values])
    checked = agg.withColumn(
        "__ok", F.when(worst > 1, F.raise_error(F.lit("pivot: duplicate cell"))).otherwise(F.lit(True))
    )
    return checked.filter(F.col("__ok")).select(
        *index, *[F.col(f"{v}_v").alias(f"{prefix}{v}") for v in values])


def unpivot(df: DataFrame, ids: list[str], values: list[str], var: str, val: str) -> DataFrame:
    """Melt wide columns into (var, val) rows."""
    return df.unpivot(ids, values, var, val)


def spearman_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Spearman matrix in long form (x, y, rho), by distributed ranks."""
    return rank_correlations(df, columns)


def histogram(df: DataFrame, value: str, bins: int, by: list[str]) -> DataFrame:
    """Equal-width bins on [min, max] of each slice ``by``; the maximum
    goes to the last bin. Every bin is emitted, empty ones with n=0."""
    if not by:
        raise ValueError("histogram needs the slice key columns")
    v = F.col(value).cast("double")
    stats = bounded_broadcast(df.groupBy(*by).agg(F.min(v).alias("lo"), F.max(v).alias("hi")), MAX_SLICES)
    width = (F.col("hi") - F.col("lo"))
    idx = F.when(width > 0, F.least(F.floor((v - F.col("lo")) * F.lit(bins) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    counts = df.filter(v.isNotNull()).join(stats, by)
    counts = counts.groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    edges = stats.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        edges.join(counts, by + ["bin"], "left")
        .select(
            *by, "bin",
            (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("bin_lo"),
            (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("bin_hi"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        )
    )


def top_n(df: DataFrame, value: str, n: int, tiebreak: str) -> DataFrame:
    """Largest ``n`` by value (ties by ``tiebreak``) -> TakeOrderedAndProject."""
    return df.orderBy(F.desc(value), F.asc(tiebreak)).limit(n)


def band_ordinal(band: str | Column = "band") -> Column:
    """Position of a band in the declared order (0-based); null outside."""
    c = F.col(band) if isinstance(band, str) else band
    pos = F.array_position(F.array(*[F.lit(b) for b in K.EXCLUSIVE_BAND_LABELS]), c)
    return F.when(pos > 0, (pos - 1).cast("int"))


def band_dimension(spark) -> DataFrame:
    """Ordered domain of the exclusive bands (band, ordinal): the fixed
    contract values as a tiny dimension for reindexing (J2)."""
    rows = F.array(*[F.struct(F.lit(label).alias("band"), F.lit(i).alias("ordinal"))
                     for i, (label, _, _) in enumerate(K.EXCLUSIVE_BANDS)])
    return spark.range(1).select(F.inline(rows))
