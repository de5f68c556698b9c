"""Tables that cut lineage, kept in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.shared import shared_dir


class Workspace:
    """Parquet tables of one operator call under the shared folder.

    A table that was written survives lost executors and ends the lineage of
    what is read from it. ``drop`` removes tables no longer needed; those that
    a returned DataFrame reads must stay until the caller is done with it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None, group_bytes: int | None = None) -> DataFrame:
        """Write ``df`` as table ``name``, in row groups of about ``group_bytes``, and return the table that was written."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        if group_bytes:
            writer = writer.option("parquet.block.size", group_bytes)
        writer.parquet(self.path(name))
        self.names.add(name)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)
            self.names.discard(name)

    def settle(self) -> None:
        """Let the context cleaner delete the shuffle files of finished steps, which it does as the driver collects its garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def keep_only(self, *names: str) -> None:
        """Drop all tables but those named."""
        self.drop(*sorted(self.names - set(names)))


#: Rows up to which a table of ids and numbers is broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def joined(df: DataFrame, few: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """df joined with a table of ids and numbers, which is counted: broadcast up to ``BROADCAST_ROWS`` rows, by shuffle beyond."""
    return df.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, on, how)


#: A key with this share of all rows, or more, is a heavy one: at most so many of them exist.
HEAVY = 10_000


def met_by_key(df: DataFrame, keys: DataFrame, on: list[str], times: str) -> DataFrame:
    """df joined with a table of distinct keys that says how often each occurs in df.

    The table is broadcast if it is small; of a larger one the heavy keys are,
    whose rows would else meet in one task, and the others are joined by shuffle.
    """
    if keys.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(keys), on)
    least = (keys.agg(F.sum(times)).first()[0] or 0) / HEAVY
    heavy, rest = keys.where(F.col(times) >= least), keys.where(F.col(times) < least)
    return df.join(F.broadcast(heavy), on).unionByName(df.join(rest, on))


def unused(name: str, *frames: DataFrame) -> str:
    """name, with underscores added until no column of the frames has it (in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, work: Workspace, name: str = "__row") -> DataFrame:
    """docs with a key for each row that is the same whenever and wherever it is read.

    The key is the place of the row in its Parquet file, and a 64-bit hash of
    the file's path. Numbers made by tasks would change with the way files are
    split, which follows the executors there are. Rows of other origin are written
    as a table first.
    """
    key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    try:
        return docs.select("*", key.alias(name))
    except AnalysisException:
        return work.table(docs, "numbered").select("*", key.alias(name))
