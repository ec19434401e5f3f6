import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tracecurate-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a column function over a list of texts."""

    def evaluate(function, values, schema="string"):
        from pyspark.sql import functions as F

        rows = [(i, value) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {schema}")
        return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return evaluate
