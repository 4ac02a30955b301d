"""Rolling error monitor over arriving forecast scores (R3 as a stream).

Scores arrive in files, in any order, late, repeated and corrected. The stream's state is one row per (geography, month): the score of the
highest version seen so far, kept across micro-batches in the checkpoint, so that an older version that arrives late changes nothing and a
repeated delivery counts once. Its size is bounded by the panel, so no month is ever closed to late rows. Every micro-batch writes the cells it changed
under ``batch=<id>`` with overwrite (a retried batch replaces its own output); the monitor reads the last state of each cell.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.features import clip_prediction
from tessera.session import scratch_path

SCORES = "geo string, start_date date, version long, actual double, prediction double, baseline double"
MARGIN = 5.0


def latest_scores(scores: DataFrame) -> DataFrame:
    """The score of the highest version per (geo, start_date); equal versions are settled by their values, not by arrival."""
    newest = F.max(F.struct("version", "actual", "prediction", "baseline")).alias("s")
    return scores.groupBy("geo", "start_date").agg(newest).select("geo", "start_date", "s.*")


def monitor_scores(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str | None = None, max_files: int = 1):
    """Take in every new score file of ``src_dir`` (available-now). The default checkpoint belongs to this pair of source and output."""
    out = out_dir.rstrip("/")
    pair = hashlib.sha1(f"{src_dir.rstrip('/')}\n{out}".encode()).hexdigest()[:16]
    arriving = spark.readStream.schema(SCORES).option("maxFilesPerTrigger", max_files).parquet(src_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/cells/batch={batch_id}")

    q = (latest_scores(arriving).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"monitor-checkpoint-{pair}")).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_cells(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every cell as its last micro-batch left it."""
    written = spark.read.parquet(f"{out_dir.rstrip('/')}/cells")
    last = F.max(F.struct("batch", "version", "actual", "prediction", "baseline")).alias("s")
    return written.groupBy("geo", "start_date").agg(last).select("geo", "start_date", "s.version", "s.actual", "s.prediction", "s.baseline")


def rolling_wape(cells: DataFrame, margin: float = MARGIN) -> DataFrame:
    """start_date, wape_2m, base_wape_2m (two months, in percent) and suspend: whether the forecast exceeds the baseline by more than ``margin`` points."""
    off = lambda c: F.sum(F.abs(F.col("actual") - clip_prediction(F.col(c))))
    months = cells.groupBy("start_date").agg(off("prediction").alias("err"), off("baseline").alias("base_err"), F.sum("actual").alias("actual"))
    two = Window.orderBy("start_date").rowsBetween(-1, 0)  # one row per month
    share = lambda c: F.try_divide(F.lit(100.0) * F.sum(c).over(two), F.sum("actual").over(two))
    r = months.select("start_date", share("err").alias("wape_2m"), share("base_err").alias("base_wape_2m"))
    return r.withColumn("suspend", F.col("wape_2m") > F.col("base_wape_2m") + margin)
