"""Re-published extracts (R5, K3): what changed, and rewriting only that.

Two levels of fingerprints: one per slice (order-free, from one aggregate over the table), and one per cell, computed only inside slices whose
fingerprints differ. ``publish`` keeps a table partitioned by slice with the fingerprints of what it holds beside it, so a new extract is compared without
reading the old rows; changed and new slices are written with dynamic partition overwrite, and files of all other slices stay as they are.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import bounded_broadcast, delete_path, write_scratch
from tessera.sources.text import content_fingerprint

MAX_SLICES = 100_000


def slice_fingerprints(df: DataFrame, slices: list[str]) -> DataFrame:
    """(slice columns, rows, fingerprint); independent of order, files and the order of columns."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in sorted(df.columns)])
    return content_fingerprint(text, slices)


def _equal(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[f"`{c}`"].eqNullSafe(b[f"`{c}`"]) for c in columns])


def _compared(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, change) of the keys whose ``value`` differs: added, removed or changed. Keys are unique on both sides."""
    joined = old.join(new, _equal(old, new, keys), "full")
    change = (F.when(old[value].isNull(), "added").when(new[value].isNull(), "removed").when(old[value] != new[value], "changed"))
    either = [F.when(new[value].isNull(), old[f"`{k}`"]).otherwise(new[f"`{k}`"]).alias(k) for k in keys]
    return joined.select(*either, change.alias("change")).where("change IS NOT NULL")


def slice_changes(old: DataFrame, new: DataFrame, slices: list[str]) -> DataFrame:
    """Slices that differ between two tables of ``slice_fingerprints``: (slice columns, change)."""
    text = lambda df: df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in slices], F.concat_ws(":", "rows", "fingerprint").alias("mark"))
    return _compared(text(old), text(new), slices, "mark")


def cell_changes(old: DataFrame, new: DataFrame, slices: list[str], keys: list[str]) -> DataFrame:
    """(keys, change) of every cell that was added, removed or changed, comparing cells only in slices that differ. ``keys`` contain the slice columns
    and name at most one row; of repeated keys the multiset of rows counts."""
    differ = write_scratch(slice_changes(slice_fingerprints(old, slices), slice_fingerprints(new, slices), slices), "changed-slices")
    differ = bounded_broadcast(differ.select(*slices), MAX_SLICES)

    def cells(df: DataFrame) -> DataFrame:
        text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in sorted(df.columns)])
        inside = text.join(differ, _equal(text, differ, slices), "left_semi")
        row = F.md5(F.concat_ws("\u001f", *[F.coalesce(F.col(f"`{c}`"), F.lit("\\N")) for c in text.columns]))
        return inside.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.concat_ws(",", F.sort_array(F.collect_list(row))).alias("mark"))

    return _compared(cells(old), cells(new), keys, "mark")


def _drop_slices(spark: SparkSession, data: str, gone: DataFrame, slices: list[str]) -> None:
    """Delete the folders of slices that are no longer there, found through the files that hold them."""
    gone = bounded_broadcast(gone, MAX_SLICES)
    if not gone.limit(1).count():
        return
    rows = spark.read.parquet(data).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in slices], F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
    for row in rows.join(gone, _equal(rows, gone, slices), "left_semi").select("folder").distinct().toLocalIterator():  # one a slice
        delete_path(spark, unquote(row["folder"]))


def publish(spark: SparkSession, new: DataFrame, root: str, slices: list[str]) -> DataFrame:
    """Bring the table at ``root`` up to ``new``, rewriting only slices that differ; returns (slice columns, change). Slice columns are strings and not null.

    Rows first, fingerprints last: a run that dies in between is repaired by the next, which finds the same differences."""
    data, marks = f"{root.rstrip('/')}/data", f"{root.rstrip('/')}/fingerprints"
    now = write_scratch(slice_fingerprints(new, slices), "fingerprints")
    try:
        before = spark.read.parquet(marks)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        before = now.limit(0)
    changes = write_scratch(slice_changes(before, now, slices), "changed-slices")
    written = bounded_broadcast(changes.where("change != 'removed'").select(*slices), MAX_SLICES)
    rows = new.join(written, _equal(new, written, slices), "left_semi")
    # one task per slice would be a hot task for a large slice: the rows stay as they are dealt, a slice may hold several files
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slices).parquet(data)
    _drop_slices(spark, data, changes.where("change = 'removed'").select(*slices), slices)
    now.write.mode("overwrite").parquet(marks)
    return changes
