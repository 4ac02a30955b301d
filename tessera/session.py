"""Session construction and shared-storage helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "tessera", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. Clusters pass their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialized intermediates.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local master may leave it
    unset (tests, ad-hoc runs): then a private scratch folder is created and
    registered. On any other master a driver-local folder would be invisible to the executors, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)  # DataFrame.checkpoint() works as well
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_root(spark), "tessera", *parts])


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: the lineage is cut and the number of partitions of
    the result follows its size."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def input_state(spark: SparkSession, *paths: str) -> tuple:
    """(path, bytes, modification time) of each input, so that results kept for an input are not used for other data under its path."""
    out = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        out.append((path, fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()))
    return tuple(out)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it holds at most ``max_rows`` rows.

    Beyond the bound the frame is returned unchanged and the planner (with AQE
    runtime statistics) picks a shuffle join instead.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers wherever they run: the package's sources go as a zip to the
    shared folder, once per application, and Spark hands it to every executor."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"package-{uuid.uuid4().hex[:12]}.zip"))
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(target.toString())
    _SHIPPED.add(app)
