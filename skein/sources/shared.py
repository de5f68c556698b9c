"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of its own where that is unset and driver and executors are one process."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="skein-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder: what reads it more than once computes it once, and so after executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """df as a table in the shared folder for as long as the block runs: what is read of it must be fetched within."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.parquet(path)
    finally:
        remove(df.sparkSession, path)
