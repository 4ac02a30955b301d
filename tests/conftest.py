import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[4]")
        .appName("tessera-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield spark


def text_rows(spark, rows):
    """rows: list of dicts keyed by header (missing -> a plain cell of the cube's own calendar)."""
    from pyspark.sql import types as T

    from tessera import contract as K

    plain = dict.fromkeys(K.SOURCE_HEADER, "1") | {
        K.SOURCE_HEADER[0]: "12/05/2001", "Start Date": "03/01/1998", "End Date": "03/31/1998", "Group": K.GRAIN_MONTH,
        "Year": "1998", "Month": "3", "Geo": "G1", "Sex": K.SEX_ALL, "Band": K.BAND_ALL, "Total Count": "10", "Footnote": None}
    data = [tuple({**plain, **r}[h] for h in K.SOURCE_HEADER) for r in rows]
    return spark.createDataFrame(data, T.StructType([T.StructField(h, T.StringType(), True) for h in K.SOURCE_HEADER]))
