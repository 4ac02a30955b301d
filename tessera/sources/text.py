"""Delimited-text source: strict schema, header contract, guards, profile."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import contract as K


class MissingInputError(FileNotFoundError):
    """The source file is absent; the message says how to produce it."""


class HeaderContractError(ValueError):
    """The source header differs from the declared contract."""


def text_schema(header: list[str] = K.SOURCE_HEADER) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType(), True) for h in header])


def nullify(df: DataFrame, *more) -> DataFrame:
    """pandas-compatible missing tokens ('NA', 'null', ...) -> NULL; ``more`` columns follow."""
    return df.select(*[
        F.when(F.col(f"`{c}`").isin(K.NA_TOKENS), F.lit(None).cast("string"))
        .otherwise(F.col(f"`{c}`")).alias(c)
        for c in df.columns
    ], *more)


#: S1-S3 for batch and stream alike: the header of every file is compared with the declared names, and a bad row fails.
STRICT_OPTIONS = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", "multiLine": "false"}


def read_text_table(spark: SparkSession, path: str, header: list[str] = K.SOURCE_HEADER) -> DataFrame:
    """Every column a string, header validated against the contract.

    ``STRICT_OPTIONS`` make Spark compare the file header with the declared
    names, so a renamed/reordered column fails instead of shifting.
    """
    try:
        df = spark.read.schema(text_schema(header)).options(**STRICT_OPTIONS).csv(path)
    except AnalysisException as exc:  # path missing
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingInputError(
                f"Required source not found at {path}. Build it with "
                "tessera.sources.store.materialize(spark, sf_dir) or point to the extract."
            ) from exc
        raise
    check_header(df.columns, header)
    return nullify(df)


def check_header(columns: list[str], header: list[str] = K.SOURCE_HEADER) -> None:
    if list(columns) != list(header):
        missing = [h for h in header if h not in columns]
        extra = [c for c in columns if c not in header]
        raise HeaderContractError(f"header mismatch: missing={missing} unexpected={extra}")


def source_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and on-disk size (MB) of a file-backed source, one pass."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
    per_file = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
    return per_file.agg(
        F.sum("n").cast("bigint").alias("raw_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("raw_columns"),
        F.round(F.sum("s") / F.lit(1024.0 ** 2), 2).alias("source_mb"),
        F.count(F.lit(1)).cast("bigint").alias("source_files"),
    )


def content_fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """Order-free fingerprint of the rows of each slice: the sum over rows of the first 60 bits of
    ``md5`` of the columns joined by a separator (nulls as a marker), modulo 2^60. Independent of file layout and partitioning."""
    text = F.concat_ws("\u001f", *[F.coalesce(F.col(f"`{c}`"), F.lit("\\N")) for c in df.columns])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum(bits).alias("__sum")).select(
        *[F.col(f"`{c}`") for c in by], "rows", (F.col("__sum") % F.lit(2 ** 60).cast("decimal(38,0)")).cast("bigint").alias("fingerprint"))
