"""Structured Streaming over a metric-history log (SS1, SS2).

The log is an append-only folder of parquet files
``(run_id, epoch, step, loss, lr, logged_at)``. Both jobs run with a
checkpoint location on shared storage, so a restarted query resumes from its
last committed micro-batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.runs import epoch_summary

HISTORY_SCHEMA = "run_id long, epoch timestamp, step long, loss double, lr double, logged_at timestamp"


def history_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None,
                   schema: str = HISTORY_SCHEMA) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def dedup_history(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """SS2 (our addition): drop re-sent ``(run_id, step)`` rows that arrive
    within ``watermark`` of each other; state is bounded by the watermark."""
    return stream.withWatermark("logged_at", watermark).dropDuplicatesWithinWatermark(["run_id", "step"])


def append_history(stream: DataFrame, sink_path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """SS2: durable append of the (deduplicated) log to parquet."""
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink_path)
    w = w.outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def running_summary(stream: DataFrame, out_path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """SS1: per (run, epoch) mean loss and last lr as steps arrive
    (``update`` mode). Each micro-batch's changed rows are written to
    ``out_path/batch_id=<n>`` with overwrite, so a replayed batch rewrites the
    same folder (idempotent sink); :func:`read_running_summary` keeps the
    newest row per key."""

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))

    agg = epoch_summary(stream)
    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_running_summary(spark: SparkSession, out_path: str) -> DataFrame:
    """Latest value per (run, epoch) over all written micro-batches."""
    df = spark.read.parquet(out_path)
    latest = df.groupBy("run_id", "epoch").agg(
        F.max_by(F.struct("avg_loss", "last_lr", "last_step", "n_steps"), F.col("batch_id")).alias("s")
    )
    return latest.select("run_id", "epoch", "s.*")
