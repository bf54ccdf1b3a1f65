"""Session settings the jobs rely on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Wall-clock columns are plain local times and instants are UTC, so the
    session zone has to be UTC. Adaptive execution sizes and splits shuffles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Feature windows cost far more time per byte than a scan: small partitions
    # are merged only up to this size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local session that names none,
    such as a test, gets a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, however
    often it is read, and safe when executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
