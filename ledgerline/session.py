"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# None of the operators needs these to be right; they are what a cluster job
# over a large ledger wants. Shuffle partitions are deliberately left to the
# cluster (or to the caller), as the right number depends on its size.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size of files from rebalanced writes and of pieces of skewed joins
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "ledgerline", **settings: str) -> SparkSession:
    """A session with the job settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A machine-local folder is only acceptable when driver and executors are
    one process, so it is the fallback for local masters alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.gettempdir()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark)}/ledgerline-{purpose}-{uuid.uuid4().hex}"
