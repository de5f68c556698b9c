"""Incremental work (STM): append-only pair files, streaming dedup, log tails, step state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.functions.jsonx import log_record, strict_strings
from skein.functions.text import dedup_key


def pair_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New JSON lines of a folder as pairs (input, output, file); lines that are no pair are left out."""
    lines = spark.readStream.format("text").load(folder).select("value", F.col("_metadata.file_name").alias("file"))
    return lines.withColumn("p", strict_strings(F.col("value"), ["input", "output"])).where("p is not null").select("p.input", "p.output", "file")


def distinct_stream(pairs: DataFrame, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Pairs with a new normalised input; with a time column keys are forgotten after the delay."""
    keyed = pairs.withColumn("dedup_key", F.sha2(dedup_key(F.col("input")), 256))
    if time is None:
        return keyed.dropDuplicates(["dedup_key"])
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["dedup_key"])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended as Parquet; a later call goes on from the checkpoint."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def best_loss_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A running row: the least validation loss of log files and its iteration."""
    lines = spark.readStream.format("text").load(folder)
    return lines.withColumn("r", log_record(F.col("value"))).where("r.val_loss is not null").agg(F.min("r.val_loss").alias("best_val_loss"), F.min_by("r.iter", "r.val_loss").alias("best_iter"))


def run_complete(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """An aggregate's whole result after each micro-batch, as Parquet in place of the one before."""
    write = lambda batch, _: batch.write.mode("overwrite").parquet(path)
    query = stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch to a function, such as an upsert of step state."""
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
