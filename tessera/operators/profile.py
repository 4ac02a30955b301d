"""Scale-free geography profiles, standardization and group summaries.

The seven-percentage profile (M1) is built in ONE conditional-aggregation
pass over the By Total / By Year rows grouped by geography: no pivots and no
alignment joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.functions.flags import pct
from tessera.operators.slices import in_domain
from tessera.session import bounded_broadcast

MAX_GROUPS = 10_000

PROFILE_FEATURES = [
    "a_pct_total",
    "b_pct_total",
    "overlap_pct_a",
    "c_pct_total",
    "senior_a_pct",
    "f_a_pct",
    "year_mid_pct",
]


def geo_profile(clean: DataFrame, years=K.PROFILE_YEARS, senior=K.SENIOR_BANDS) -> DataFrame:
    g, s, b = F.col("grain"), F.col("sex"), F.col("band")
    tot = (g == K.GRAIN_TOTAL) & (s == K.SEX_ALL) & (b == K.BAND_ALL)

    def cell(cond, m):
        return F.max(F.when(cond, F.col(m)))

    senior_a = F.when((g == K.GRAIN_TOTAL) & (s == K.SEX_ALL) & b.isin(list(senior)), F.col("a"))
    y = [cell((g == K.GRAIN_YEAR) & (F.col("year") == yr) & (s == K.SEX_ALL) & (b == K.BAND_ALL), "a")
         for yr in years]
    src = in_domain(clean.filter(g.isin(K.GRAIN_TOTAL, K.GRAIN_YEAR)))
    wide = src.groupBy("geo").agg(
        cell(tot, "a").alias("a"),
        cell(tot, "total").alias("total"),
        cell(tot, "b").alias("b"),
        cell(tot, "overlap").alias("overlap"),
        cell(tot, "c").alias("c"),
        # sum(min_count=3): null unless all three senior bands are present
        F.when(F.count(senior_a) >= len(senior), F.sum(senior_a)).alias("senior_a"),
        cell((g == K.GRAIN_TOTAL) & (s == K.SEX_PARTS[0]) & (b == K.BAND_ALL), "a").alias("a_p0"),
        cell((g == K.GRAIN_TOTAL) & (s == K.SEX_PARTS[1]) & (b == K.BAND_ALL), "a").alias("a_p1"),
        *[c.alias(f"a_y{i}") for i, c in enumerate(y)],
    )
    # row-wise yearly sum skips nulls; the part/part+part share propagates them
    ysum = sum((F.coalesce(F.col(f"a_y{i}"), F.lit(0.0)) for i in range(len(years))), F.lit(0.0))
    return wide.select(
        "geo",
        pct("a", "total").alias("a_pct_total"),
        pct("b", "total").alias("b_pct_total"),
        pct("overlap", "a").alias("overlap_pct_a"),
        pct("c", "total").alias("c_pct_total"),
        pct("senior_a", "a").alias("senior_a_pct"),
        pct("a_p0", F.col("a_p0") + F.col("a_p1")).alias("f_a_pct"),
        pct(f"a_y{len(years) // 2}", ysum).alias("year_mid_pct"),
    )


def fit_population_scaler(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """M2 (fit): mean and *population* std per feature in one aggregate.

    Like an ml Estimator, only the 2 x n_features parameters reach the
    driver. A zero (or undefined) std becomes scale 1.
    """
    row = df.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                 *[F.stddev_pop(f).alias(f"s_{f}") for f in features]).first()
    out = {}
    for f in features:
        sd = row[f"s_{f}"]
        out[f] = (row[f"m_{f}"], sd if sd not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """M2 (transform): (x - mean) / std with the fitted literals."""
    return df.select(
        *[c for c in df.columns if c not in params or suffix],
        *[((F.col(f) - F.lit(m)) / F.lit(s)).alias(f + suffix) for f, (m, s) in params.items()],
    )


def standardize(df: DataFrame, features: list[str]) -> DataFrame:
    return apply_scaler(df, fit_population_scaler(df, features))


def attach_groups(profile: DataFrame, nation: DataFrame) -> DataFrame:
    """Group key per geography: the nation's region (n_regionkey)."""
    return profile.join(
        nation.select(F.col("n_name").alias("geo"), F.col("n_regionkey").alias("grp")), "geo", "inner")


def group_profile(df: DataFrame, features: list[str], group: str = "grp") -> DataFrame:
    """G13 + G14: mean per group and group size."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).cast("bigint").alias("size"),
        *[F.avg(f).alias(f) for f in features],
    )


def group_profile_z(df: DataFrame, features: list[str], group: str = "grp") -> DataFrame:
    """(group mean - overall mean) / overall population std.

    Overall statistics come from a grouping-set aggregate in the same pass
    (GROUPING SETS ((group), ())), so the scalar is attached by a small
    equi-join on the grouping id instead of a cartesian product.
    """
    stats = df.rollup(group).agg(
        F.grouping_id().alias("__gid"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    )
    per = stats.filter(F.col("__gid") == 0)
    overall = stats.filter(F.col("__gid") == 1).select(
        F.lit(0).alias("__gid"), *[F.col(f"m_{f}").alias(f"om_{f}") for f in features],
        *[F.col(f"s_{f}").alias(f"os_{f}") for f in features])
    j = per.join(overall, "__gid")
    return j.select(group, *[
        F.try_divide(F.col(f"m_{f}") - F.col(f"om_{f}"), F.col(f"os_{f}")).alias(f) for f in features])


def group_members(df: DataFrame, group: str = "grp", member: str = "geo") -> DataFrame:
    """Sorted member list per group, as an array and joined text."""
    return df.groupBy(group).agg(F.sort_array(F.collect_list(member)).alias("members")).select(
        group, "members", F.array_join("members", ", ").alias("members_text"))


def relabel_groups(df: DataFrame, stat: str, group: str = "grp") -> DataFrame:
    """W4 + J3: new label = rank of the group's mean ``stat`` (ties by old id).

    The ranking window runs over the k-row group table (k = number of
    groups), never over member rows; the remap is broadcast after a count.
    """
    means = df.groupBy(group).agg(F.avg(stat).alias("__m"))
    k_rows = Window.orderBy(F.col("__m").asc_nulls_last(), F.col(group))  # k rows only
    remap = means.select(group, (F.row_number().over(k_rows) - 1).alias("new_group"))
    return df.join(bounded_broadcast(remap, MAX_GROUPS), group, "inner")
