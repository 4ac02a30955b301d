"""Grain-safe slices (F1-F7, J4): never mix totals with their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import contract as K


def _match(col: str, value) -> Column:
    if isinstance(value, (list, tuple, set)):
        return F.col(col).isin(list(value))
    return F.col(col) == value


DIMENSIONS = ("grain", "geo", "sex", "band")
#: Level of a geography column from which totals and overlapping areas are gone.
DOMAIN = "(domain)"
_ADDITIVE = {"band": set(K.EXCLUSIVE_BAND_LABELS), "sex": set(K.SEX_PARTS), "geo": {DOMAIN}}


class LevelError(ValueError):
    """An aggregation would mix totals with their parts."""


def _with_levels(df: DataFrame, dim: str, values: list) -> DataFrame:
    """R2: note in the metadata of every measure which levels of ``dim`` its rows hold; the note follows the measure through selects and joins."""
    def noted(c: str) -> Column:
        known = df.schema[c].metadata
        return F.col(c).alias(c, metadata={**known, "levels": {**known.get("levels", {}), dim: values}})

    return df.select(*[noted(c) if c in K.MEASURES else F.col(f"`{c}`") for c in df.columns])


def sliced(df: DataFrame, measure: str) -> bool:
    """Whether ``measure`` is a column that came through a slice; frames made elsewhere carry no levels to judge."""
    return measure in df.columns and "levels" in df.schema[measure].metadata


def mixed_levels(df: DataFrame, measure: str, by=()) -> dict[str, object]:
    """The dimensions outside ``by`` over which a sum of ``measure`` would mix levels: name -> levels (None: never sliced)."""
    levels = df.schema[measure].metadata.get("levels", {})
    fits = {d: d in by or (d in levels and (len(levels[d]) == 1 or set(levels[d]) <= _ADDITIVE.get(d, set()))) for d in DIMENSIONS}
    return {d: levels.get(d) for d, ok in fits.items() if not ok}


def require_levels(df: DataFrame, measure: str = "a", by=()) -> DataFrame:
    """R2 at plan time: ``df``, if aggregating ``measure`` by the columns ``by`` mixes no totals with parts; else an error, without a job."""
    mixed = mixed_levels(df, measure, by)
    if mixed:
        raise LevelError(f"aggregating {measure} mixes levels of {mixed}")
    return df


def grain_slice(df: DataFrame, grain=None, geo=None, sex=None, band=None, year=None) -> DataFrame:
    """Rows at one level of every dimension that is given.

    Filters on partition/dimension columns, so ``grain`` prunes Parquet
    partitions and the rest become pushed-down row-group filters.
    """
    chosen = [(c, v) for c, v in (("grain", grain), ("geo", geo), ("sex", sex), ("band", band), ("year", year)) if v is not None]
    for c, v in chosen:
        df = df.filter(_match(c, v))
    for c, v in chosen:
        if c in DIMENSIONS:
            df = _with_levels(df, c, sorted(v) if isinstance(v, (list, tuple, set)) else [v])
    return df


def geo_domain(df: DataFrame, excluded=K.GEO_EXCLUDED) -> DataFrame:
    """sorted geography domain by set difference."""
    return df.select("geo").distinct().filter(~F.col("geo").isin(list(excluded))).orderBy("geo")


def in_domain(df: DataFrame, excluded=K.GEO_EXCLUDED) -> DataFrame:
    """Restrict to the geography domain as a pushed-down predicate (no join)."""
    kept = df.filter(~F.col("geo").isin(list(excluded)))
    return _with_levels(kept, "geo", [DOMAIN]) if set(K.GEO_EXCLUDED) <= set(excluded) else kept


def semi_join_domain(df: DataFrame, domain: DataFrame) -> DataFrame:
    """Keep rows whose geography is in ``domain`` (left semi join)."""
    return df.join(domain.select("geo"), "geo", "left_semi")


def complete_periods(df: DataFrame) -> DataFrame:
    """drop partial periods."""
    return df.filter(~F.col("is_partial_period"))


def assert_single_level(df: DataFrame, dims=("grain", "geo", "sex", "band")) -> None:
    """R2: a slice fed to an aggregate must hold exactly one level per dimension
    among ``dims`` (one small aggregate job)."""
    row = df.agg(*[F.count_distinct(F.col(d)).alias(d) for d in dims]).first()
    bad = {d: row[d] for d in dims if row[d] not in (0, 1)}
    if bad:
        raise ValueError(f"slice mixes levels: {bad}")
