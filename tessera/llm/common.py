"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import delete_path, scratch_path, ship_package

#: A word is a run of characters other than space, tab, newline, vertical tab, form feed and return.
WORD_RE = r"[^\x20\x09-\x0D]+"
WHITESPACE = " \t\n\x0b\x0c\r"
UPPER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = UPPER_AZ.lower()
#: Bytes of text that Spark hands to a Python worker at once; bounds its memory for texts of any length.
ARROW_BATCH_BYTES = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def stash_buckets(df: DataFrame, name: str, key: str, buckets: int, codec: str = "snappy") -> DataFrame:
    """Like ``stash``, in buckets of ``key``: stashes of as many buckets are joined by it without a shuffle."""
    spark = df.sparkSession
    entry = f"tessera_{uuid.uuid4().hex}"  # buckets need an entry in the catalog until the table is read; its files stay when it goes
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).option("compression", codec).saveAsTable(entry)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return out


def drop_stash(df: DataFrame) -> None:
    """Delete a stash that a later one replaces; ``df`` must be what ``stash`` returned, and nothing may read it afterwards."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/tessera/llm/" not in folder:
            raise ValueError(f"{folder} is no stash")
        delete_path(df.sparkSession, folder)


@contextmanager
def _conf_set(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession):
    """Spark removes the shuffle files of each query once it has ended. For jobs whose results are written: a frame that is
    run again shuffles again."""
    return _conf_set(spark, {FREE_SHUFFLES: "true"})


def rows_of_numbers(spark: SparkSession):
    """For jobs whose many rows are a few numbers each: Spark limits Arrow batches by rows only, for weighing each row takes longer than
    writing it. Large rows must be few in a partition, so stashes in buckets are read bucket by bucket."""
    return _conf_set(spark, {ARROW_BYTES: str((1 << 31) - 1), "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"})


def prepare_workers(spark: SparkSession) -> None:
    """For tasks in Python: the package on every executor, and Arrow batches limited by bytes, not only by rows."""
    ship_package(spark)
    spark.conf.set(ARROW_BYTES, str(ARROW_BATCH_BYTES))


def lower_az(c: Column) -> Column:
    """A-Z to a-z and nothing else. For pure ASCII, ``lower`` does the same and is faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER_AZ, LOWER_AZ))


def text_bytes(c: Column) -> Column:
    """The UTF-8 bytes of a text; ``bytes.split`` on them splits at exactly the whitespace of ``WORD_RE``."""
    return c.cast("binary")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_last(c: Column) -> Column:
    """A sort key that puts nulls behind every value, also inside min() and max()."""
    return F.struct(c.isNull().alias("absent"), c.alias("id"))


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast only when a count proves the bound; else the planner picks a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


Query = Callable[[SparkSession, str], DataFrame]
