"""State by key in a stream (STM-06): the last transition of each step, stale fields cleared, stalled steps by a timer.

What is kept of a step is its latest transition and its latest start. Both are maxima by time and id, so
transitions may come in any order, in any batches, and more than once. A large group is folded frame
by frame; nothing of it is sorted or held together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEPT = "last long, last_id long, status string, error string, began long, began_id long"
CHANGES = "step_id string, status string, started long, ended long, error string, stalled boolean"
NEVER = -(1 << 62)


def _fold(kept: tuple, frame: pd.DataFrame) -> tuple:
    last, last_id, status, error, began, began_id = kept
    order = frame.sort_values(["micros", "id"], kind="stable")
    final = order.iloc[-1]
    if (final["micros"], final["id"]) > (last, last_id):
        last, last_id, status = int(final["micros"]), int(final["id"]), final["status"]
        error = final["error"] if status == "failed" else None
    starts = order[order["status"] == "running"]
    if len(starts) and (starts["micros"].iloc[-1], starts["id"].iloc[-1]) > (began, began_id):
        began, began_id = int(starts["micros"].iloc[-1]), int(starts["id"].iloc[-1])
    return last, last_id, status, error, began, began_id


def _machine(patience: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else (NEVER, NEVER, None, None, NEVER, NEVER)
        stalled = state.hasTimedOut
        if not stalled:
            for frame in frames:
                frame = frame[frame["status"].notna()]
                if len(frame):
                    kept = _fold(kept, frame)
            if kept[2] is None:
                return
            state.update(kept)
            if kept[2] == "running":
                due = (kept[0] + patience) // 1000
                stalled = due <= state.getCurrentWatermarkMs()
                if not stalled:
                    state.setTimeoutTimestamp(due)
        last, _, status, error, began, _ = kept
        started, ended = (None if began == NEVER else began), (None if status == "running" else last)
        row = {"step_id": key[0], "status": status, "started": started, "ended": ended, "error": error, "stalled": stalled}
        yield pd.DataFrame({k: pd.Series([v], dtype=object) for k, v in row.items()})

    return step


def step_states(transitions: DataFrame, delay: str = "1 hour", patience_seconds: int = 86_400) -> DataFrame:
    """Changes (``CHANGES``) of a stream of transitions (step_id, status, at, id, error).

    status is running, completed or failed; the latest by (at, id) counts. A start clears end and error, an end clears
    the error of an earlier one. A step that runs for longer than its patience, by the time of the stream, is stalled.
    Rows without a status are no transitions, but the stream's time goes on with them; so they are left out by step, after the
    watermark: Spark would move a filter below it.
    """
    micros = F.unix_micros("at").alias("micros")
    rows = transitions.where("step_id is not null and at is not null").withWatermark("at", delay).select("step_id", "status", "at", micros, F.col("id").cast("long"), "error")
    return rows.groupBy("step_id").applyInPandasWithState(_machine(patience_seconds * 1_000_000), CHANGES, KEPT, "update", GroupStateTimeout.EventTimeTimeout)


def run_states(changes: DataFrame, path: str, checkpoint: str) -> None:
    """All changes that are there now, as Parquet by micro-batch; a batch that runs again replaces what it wrote."""
    write = lambda rows, number: rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
    changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def last_states(spark: SparkSession, path: str) -> DataFrame:
    """The state of each step (step_id, status, started_at, completed_at, duration_seconds, error, stalled) by the last batch that changed it."""
    rows = spark.read.schema(f"{CHANGES}, batch long").parquet(path)
    last = rows.groupBy("step_id").agg(F.max_by(F.struct("status", "started", "ended", "error", "stalled"), "batch").alias("s")).select("step_id", "s.*")
    seconds = (F.col("ended") - F.col("started")) / F.lit(1e6)
    return last.select("step_id", "status", F.timestamp_micros("started").alias("started_at"), F.timestamp_micros("ended").alias("completed_at"), seconds.alias("duration_seconds"), "error", "stalled")
