"""Stage tables: results that are read more than once are written and read back.

A stage table survives the loss of executors, cuts the lineage, and lets every later
reader prune columns. It lives in the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, else the one set on the context. Only a session
    on one machine, as in tests, gets a temporary folder if it has neither."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tracecurate-"))
    return context.getCheckpointDir().rstrip("/")


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    path = path or new_stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
