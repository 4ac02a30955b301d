"""Suppressed cells as intervals (R1, A16), narrowed through the sums that tie them to published cells.

A published cell is the interval [v, v], a suppressed one [1, 9], any other missing one [0, ``OPEN``]. Five families of sums hold in the dense cube:
exclusive bands, sexes, geographies, months of a year and years of the total each add up to their parent. A sum narrows its parent to the
sum of its children's bounds, and every child to what the parent leaves over once the other children take their bounds. Families are applied in turn until
no interval changes: bounds only ever tighten, so the result is the one fixed point whatever the order.

Each family is one window per cell group (one level of a dimension, tens of rows), all measures at once: a round costs one shuffle a family, and is
written to shared storage before the next. A round that changes nothing is told by the sum of all widths, one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.session import write_scratch

#: Upper bound of a cell that is missing without being suppressed; far above any count, far below the loss of whole numbers.
OPEN = 1e12
CELL = ["grain", "start_date", "geo", "sex", "band"]


def bounds(clean: DataFrame, measures=K.MEASURES) -> DataFrame:
    """The cells with ``lower_m`` and ``upper_m`` of every measure."""
    def ends(m: str) -> list[Column]:
        hidden = F.col(f"{m}_suppressed")
        return [F.coalesce(m, F.when(hidden, F.lit(float(K.SUPPRESS_LO))).otherwise(F.lit(0.0))).alias(f"lower_{m}"),
                F.coalesce(m, F.when(hidden, F.lit(float(K.SUPPRESS_HI))).otherwise(F.lit(OPEN))).alias(f"upper_{m}")]

    return clean.select(*CELL, "year", *[f"{m}_suppressed" for m in measures], *[c for m in measures for c in ends(m)])


def _role(column: str, parent: str, children) -> Column:
    """True for the parent of a sum, false for its children, null for rows outside the family."""
    c = F.col(column)
    return F.when(c == parent, True).when(children(c), False)


def families() -> dict[str, tuple[list[str], Column]]:
    """Name -> (columns that the parent and its children share, role of a row)."""
    return {
        "bands": (["grain", "start_date", "geo", "sex"], _role("band", K.BAND_ALL, lambda c: c.isin(K.EXCLUSIVE_BAND_LABELS))),
        "sexes": (["grain", "start_date", "geo", "band"], _role("sex", K.SEX_ALL, lambda c: c.isin(K.SEX_PARTS))),
        "geos": (["grain", "start_date", "sex", "band"], _role("geo", K.GEO_ALL, lambda c: ~c.isin(K.GEO_EXCLUDED))),
        "months": (["year", "geo", "sex", "band"], _role("grain", K.GRAIN_YEAR, lambda c: c == K.GRAIN_MONTH)),
        "years": (["geo", "sex", "band"], _role("grain", K.GRAIN_TOTAL, lambda c: c == K.GRAIN_YEAR)),
    }


def narrow(cells: DataFrame, family: tuple[list[str], Column], measures) -> DataFrame:
    """One application of one family of sums."""
    keys, role = family
    # rows outside the family share no sum: the cell itself keeps them apart
    apart = [F.when(F.col("__parent").isNull(), F.xxhash64(*CELL)).alias("__apart")]
    rows = cells.withColumn("__parent", role).select("*", *apart)
    group = Window.partitionBy(*keys, "__apart")
    parent, child = F.col("__parent"), ~F.col("__parent")
    sums = {}
    for m in measures:
        for end in ("lower", "upper"):
            c = F.col(f"{end}_{m}")
            sums[f"__sum_{end}_{m}"] = F.sum(F.when(child, c)).over(group)
            sums[f"__of_{end}_{m}"] = F.max(F.when(parent, c)).over(group)
    rows = rows.withColumns(sums)

    def tightened(m: str) -> dict[str, Column]:
        low, up = F.col(f"lower_{m}"), F.col(f"upper_{m}")
        sum_low, sum_up, of_low, of_up = (F.col(f"__{s}_{e}_{m}") for s in ("sum", "of") for e in ("lower", "upper"))
        return {f"lower_{m}": F.when(parent, F.greatest(low, sum_low)).when(child, F.greatest(low, of_low - (sum_up - up))).otherwise(low),
                f"upper_{m}": F.when(parent, F.least(up, sum_up)).when(child, F.least(up, of_up - (sum_low - low))).otherwise(up)}

    return rows.withColumns({k: v for m in measures for k, v in tightened(m).items()}).select(*cells.columns)


def _width(cells: DataFrame, measures) -> float:
    return cells.agg(F.sum(sum((F.col(f"upper_{m}") - F.col(f"lower_{m}") for m in measures), F.lit(0.0)))).first()[0] or 0.0


def tighten(clean: DataFrame, measures=K.MEASURES, which=None) -> DataFrame:
    """The narrowest bounds that the sums of the families ``which`` (default: all) prove for every cell."""
    chosen = [f for name, f in families().items() if which is None or name in which]
    cells = bounds(clean, measures)
    before = _width(cells, measures)
    while True:
        for family in chosen:
            cells = narrow(cells, family, measures)
        cells = write_scratch(cells, "intervals")
        now = _width(cells, measures)
        if now == before:
            return cells
        before = now


def suppressed_bounds(cells: DataFrame, measures=K.MEASURES) -> DataFrame:
    """Long form of the suppressed cells: cell, measure, lower, upper."""
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}_suppressed").alias("hidden"), F.col(f"lower_{m}").alias("lower"), F.col(f"upper_{m}").alias("upper"))
                     for m in measures])
    return cells.select(*CELL, F.inline(each)).where("hidden").drop("hidden")


def reconcile_bounds(clean: DataFrame, measures=K.MEASURES) -> DataFrame:
    """A16 for every measure, geography and sex: per measure and family the sums that published values alone confirm, those whose parent lies
    inside the bounds of its children, and those that contradict it."""
    cells, out = bounds(clean, measures), None
    for name, (keys, role) in families().items():
        each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"lower_{m}").alias("lower"), F.col(f"upper_{m}").alias("upper")) for m in measures])
        rows = cells.withColumn("__parent", role).where(F.col("__parent").isNotNull()).select(*keys, "__parent", F.inline(each))
        take = lambda which, c, f: f(F.when(which, F.col(c)))
        per = rows.groupBy(*keys, "measure").agg(
            take(F.col("__parent"), "lower", F.max).alias("pl"), take(F.col("__parent"), "upper", F.max).alias("pu"),
            take(~F.col("__parent"), "lower", F.sum).alias("sl"), take(~F.col("__parent"), "upper", F.sum).alias("su"))
        both = per.where("pl IS NOT NULL AND sl IS NOT NULL")
        possible = (F.col("sl") <= F.col("pu")) & (F.col("pl") <= F.col("su"))
        settled = (F.col("pl") == F.col("pu")) & (F.col("sl") == F.col("su"))
        counts = both.groupBy("measure").agg(F.count_if(settled & possible).alias("exact"), F.count_if(~settled & possible).alias("within"),
                                             F.count_if(~possible).alias("violated")).select(F.lit(name).alias("family"), "measure", "exact", "within", "violated")
        out = counts if out is None else out.unionByName(counts)
    return out
