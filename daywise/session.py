"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizes are per task, so they hold whatever the total is: a shuffle starts with many partitions,
# AQE merges them to the advisory size by what they really hold, and splits those that are skewed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_folder: dict[str, str] = {}


def build_session(app: str = "daywise", master: str | None = None, **extra: str) -> SparkSession:
    """A session with `SETTINGS`; keyword names use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folder:
        _local_folder[context.applicationId] = tempfile.mkdtemp(prefix="daywise-")
    return _local_folder[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a not yet existing folder below the shared one."""
    return f"{shared_folder(spark)}/daywise/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: short lineage that outlives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
