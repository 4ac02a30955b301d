"""Connected components as joins: alternating large-star and small-star rounds.

Every round rewrites the edge table so that each node points at a smaller one; the rounds end when no
edge changes. A chain of n nodes takes a number of rounds that grows with log n, every round is written
to the shared folder, and neither edges nor labels pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node with the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, F.col("u") == F.col("node"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, with the smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least.withColumnRenamed("u", "node"), F.col("u") == F.col("node"))
    others = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the smallest node of the component."""
    def facts(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.sum((F.xxhash64("u", "v") % 1_000_003).cast("long")).alias("sum")).first()
        return row["n"], row["sum"]

    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    now = stash(down, "edges")
    seen = facts(now)
    while seen[0]:
        now = stash(_small_star(_large_star(now)), "edges")
        before, seen = seen, facts(now)
        if before == seen:
            break
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
