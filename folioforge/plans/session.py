"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> SparkSession:
    """Let Python workers that start later find this package where the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])
    return spark


def reuse(df: DataFrame) -> DataFrame:
    """A frame that several branches of a plan read, computed once: a checkpoint where the session has a folder for them, which lost
    executors do not touch; else kept by the session."""
    if df.sparkSession.sparkContext.getConf().get("spark.checkpoint.dir"):
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)
