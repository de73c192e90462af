"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work the operators count on: it splits skewed join
# partitions, merges small ones, and turns a join into a broadcast only after measuring the side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, or the checkpoint folder set in code.

    Only a local master may fall back on a temporary folder: on a cluster the executors would not
    share it, and losing one of them would lose its part of the table.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A folder no other run uses."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files that outlive executors."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
