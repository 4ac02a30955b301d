"""Exact quantiles and ranks without gathering a slice.

Quantiles: the values at the wanted ranks are found by narrowing. Every pass counts the values of a range in ``BINS`` bins (count, least, greatest:
state of fixed size, combined before the shuffle), follows each rank into its bin and goes on with that bin's least and greatest value as the next range; a
rank at the end of its bin, or in a bin of equal values, is found. Even passes divide a logarithmic scale, odd ones a linear one, so that neither
wide nor narrow ranges stall: two or three passes for usual columns, about eight for the whole range of doubles.

Ranks: equal values are counted first, so that no value is hot; the distinct values are range-partitioned, each partition's total becomes the
offset of the next, and only the order inside one partition needs a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import bounded_broadcast, write_scratch

BINS = 1024
#: Ranges that are broadcast at once; beyond it they are joined by their slice.
MAX_RANGES = 100_000


def _scale(v: Column, logarithmic: bool) -> Column:
    """A non-decreasing scale for dividing a range; halved where it is linear, so that differences stay finite."""
    return F.signum(v) * F.log1p(F.abs(v)) if logarithmic else v / 2


def _same(a: DataFrame, b: DataFrame, by: list[str]) -> Column:
    """Equality of the slice columns, nulls included; ``b``'s carry a prefix."""
    cond = F.lit(True)
    for c in by:
        cond = cond & a[c].eqNullSafe(b[f"__{c}"])
    return cond


def values_at_ranks(rows: DataFrame, wanted: DataFrame, by: list[str], bins: int = BINS) -> DataFrame:
    """``wanted`` (by, rank from 0, lo, hi: the range of the slice) with the value at each rank. ``rows``: by, __v (finite, not null)."""
    state = write_scratch(wanted.select(*by, "rank", "lo", "hi", F.lit(0).cast("long").alias("below"), F.lit(None).cast("double").alias("value")), "ranks")
    logarithmic = True
    while state.where("value IS NULL").limit(1).count():
        open_ranks = state.where("value IS NULL")
        ranges = open_ranks.select(*[F.col(c).alias(f"__{c}") for c in by], "lo", "hi").distinct()
        ranges = bounded_broadcast(ranges, MAX_RANGES)
        inside = rows.join(ranges, _same(rows, ranges, by) & rows["__v"].between(F.col("lo"), F.col("hi"))).select(*by, "__v", "lo", "hi")
        span = _scale(F.col("hi"), logarithmic) - _scale(F.col("lo"), logarithmic)
        share = F.try_divide(_scale(F.col("__v"), logarithmic) - _scale(F.col("lo"), logarithmic), span)
        slot = F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0))
        counted = inside.groupBy(*by, "lo", "hi", slot.alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.min("__v").alias("least"), F.max("__v").alias("most"))
        order = Window.partitionBy(*by, "lo", "hi").orderBy("slot")  # at most ``bins`` rows
        counted = counted.withColumn("before", F.sum("n").over(order) - F.col("n"))
        c = counted.select(*[F.col(x).alias(f"__{x}") for x in by], F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), "n", "least", "most", "before")
        place = F.col("rank") - F.col("below") - F.col("before")
        met = open_ranks.join(c, _same(open_ranks, c, by) & (F.col("lo") == F.col("__lo")) & (F.col("hi") == F.col("__hi")) & (place >= 0) & (place < F.col("n")))
        value = F.when((F.col("least") == F.col("most")) | (place == 0), F.col("least")).when(place == F.col("n") - 1, F.col("most"))
        met = met.select(*by, "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("before")).alias("below"), value.alias("value"))
        state = write_scratch(state.where("value IS NOT NULL").unionByName(met), "ranks")
        logarithmic = not logarithmic
    return state.select(*by, "rank", "value")


def exact_quantiles(df: DataFrame, value: str, probs=(0.25, 0.75), by: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """G1: per slice the quantiles q<percent> with linear interpolation between ranks (the pandas default); null without values. Values are finite numbers."""
    by = by or []
    if not all(0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    rows = df.select(*by, F.col(value).cast("double").alias("__v"))
    slices = write_scratch(rows.groupBy(*by).agg(F.count("__v").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")), "quantile-slices")
    places = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    ends = F.array(*[f(h).cast("long") for h in places for f in (F.floor, F.ceil)])
    wanted = slices.where("n > 0").select(*by, "lo", "hi", F.explode(F.array_distinct(ends)).alias("rank"))
    found = values_at_ranks(rows.where(F.col("__v").isNotNull()), wanted, by, bins)
    per = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))  # two ranks a probability
    per = per.select(*[F.col(c).alias(f"__{c}") for c in by], "at")

    def quantile(h: Column) -> Column:
        low, high = F.element_at("at", F.floor(h).cast("long")), F.element_at("at", F.ceil(h).cast("long"))
        return low + (high - low) * (h - F.floor(h))

    joined = slices.join(per, _same(slices, per, by), "left")
    return joined.select(*by, *[F.when(F.col("n") > 0, quantile(h)).alias(f"q{int(round(p * 100))}") for p, h in zip(probs, places)])


def average_ranks(counts: DataFrame, value: str, by: list[str], weight: str = "n") -> DataFrame:
    """(by, value, n, rank): the rank of every distinct value of a slice, ties at their average. ``counts`` may hold a value more than once;
    its rows stand for ``weight`` rows each. Null values have no rank."""
    distinct = counts.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum(weight).cast("long").alias("n"))
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) for c in (*by, value)]
    dealt = distinct.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    ordered = write_scratch(dealt, "rank-values")
    totals = ordered.groupBy(*by, "__part").agg(F.sum("n").alias("__size"))  # at most one row a slice and partition
    ahead = F.sum("__size").over(Window.partitionBy(*by).orderBy("__part")) - F.col("__size")
    offsets = totals.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__p"), ahead.alias("__ahead"))
    inside = F.sum("n").over(Window.partitionBy(*by, "__part").orderBy(value)) - F.col("n")
    placed = ordered.withColumn("__inside", inside)
    joined = placed.join(offsets, _same(placed, offsets, by) & (F.col("__part") == F.col("__p")))
    return joined.select(*by, value, "n", (F.col("__ahead") + F.col("__inside") + (F.col("n") + 1) / F.lit(2.0)).alias("rank"))


def rank_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spearman's rho of every pair of columns on the rows where both are present, as rows (x, y, rho) in both directions; null if a side is constant."""
    pairs = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(x).cast("double").alias("xv"), F.col(y).cast("double").alias("yv"))
                      for i, x in enumerate(columns) for y in columns[i:]])
    long = df.select(F.inline(pairs)).where("xv IS NOT NULL AND yv IS NOT NULL")
    points = write_scratch(long.groupBy("x", "y", "xv", "yv").agg(F.count(F.lit(1)).alias("n")), "rank-points")
    by = ["x", "y"]
    rx = average_ranks(points, "xv", by).select(*by, "xv", F.col("rank").alias("rx"))
    ry = average_ranks(points, "yv", by).select(*by, "yv", F.col("rank").alias("ry"))
    middle = points.groupBy(*by).agg(((F.sum("n") + 1) / F.lit(2.0)).alias("middle"))  # the mean of all ranks
    ranked = points.join(rx, [*by, "xv"]).join(ry, [*by, "yv"]).join(bounded_broadcast(middle, MAX_RANGES), by)
    dx, dy = F.col("rx") - F.col("middle"), F.col("ry") - F.col("middle")
    sums = ranked.groupBy(*by).agg(F.sum(F.col("n") * dx * dy).alias("xy"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dy * dy).alias("yy"))
    rho = sums.select(*by, F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("rho"))
    both = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    return rho.select(F.inline(F.array_distinct(both)), "rho")
