"""Cluster quality measures on labelled vectors.

* ``inertia_by_label``: sum of squared distances to each label's centroid,
  from one grouped vector aggregate.
* ``silhouette_sq``: silhouette under *squared* Euclidean distance, which
  decomposes through per-cluster sums (O(n*k*d), no pairwise distances):
  sum_y ||x-y||^2 = n_C*||x||^2 - 2*x.S_C + Q_C. This is Spark's
  ``ClusteringEvaluator`` definition; it differs from the plain-Euclidean
  silhouette of the reference (which needs all point pairs) and is reported
  under its own name.
"""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """FLOAT array -> DOUBLE ml Vector."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def inertia_by_label(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Each label's squared distances to its centroid are its vector variance
    times (n - 1): one grouped aggregate with map-side merging, no vector is shuffled. Rows without a label do not count."""
    stats = Summarizer.metrics("variance", "count").summary(F.col(features))
    per = df.where(F.col(label).isNotNull()).groupBy(label).agg(stats.alias("__s"))
    spread = F.aggregate(vector_to_array("__s.variance"), F.lit(0.0), lambda acc, v: acc + v)
    return per.agg(
        F.sum(spread * (F.col("__s.count") - 1)).alias("inertia"),
        F.sum("__s.count").cast("bigint").alias("n_points"),
        F.count(F.lit(1)).cast("bigint").alias("n_clusters"),
    )


def silhouette_sq(df: DataFrame, features: str = "features", label: str = "label") -> float:
    """Mean silhouette with squared Euclidean distance (single-member
    clusters score 0) of the rows that have a label."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="__pred", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return ev.evaluate(df.where(F.col(label).isNotNull()).withColumn("__pred", F.col(label).cast("double")))
