"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Correctness settings; sizing settings (executors, memory, shuffle partitions) belong to spark-submit.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans here have thousands of column nodes; recording a Python call site for each doubles build time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "lossgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; on a cluster the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the shared folder every executor can reach.

    A machine-local folder is used only by local-mode sessions that leave the setting unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lossgrid-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several jobs will read, and read it back: lineage ends at shared storage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
