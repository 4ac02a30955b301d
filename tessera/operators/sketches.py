"""Distinct counts that merge (A3 over batches): HyperLogLog sketches stored beside exact counts.

Exact distinct counts of two batches cannot be added; their sketches can be united without reading the rows again. Sketches have a fixed
size (2 ** ``LOG_SIZE`` registers), so a table of them grows with batches, not with rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12
#: Three standard errors of a sketch, the bound within which an estimate must lie.
BOUND = 3 * 1.04 / math.sqrt(1 << LOG_SIZE)


def batch_sketches(df: DataFrame, batch: list[str], columns: list[str], log_size: int = LOG_SIZE) -> DataFrame:
    """(batch, field, rows, exact, sketch): per batch and column the values present, how many are distinct, and their sketch. One pass, one
    row a column and batch; a column without values has an empty sketch."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])
    long = df.select(*batch, F.inline(fields))
    return long.groupBy(*batch, "field").agg(
        F.count("v").alias("rows"), F.count_distinct("v").alias("exact"), F.hll_sketch_agg("v", log_size).alias("sketch"))


def merged_counts(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, field, batches, rows, estimate) over all batches of ``batch_sketches``, from the sketches alone."""
    return sketches.groupBy(*(by or []), "field").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("estimate"))
