"""Streaming queries over the metric-history log derived from ``events``
(SS1, SS2). The batch view is written as a file log, the streams run to
completion with ``availableNow`` triggers, and the sinks are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.catalog import register
from tessera.plans.runs_queries import TS_FMT_SQL
from tessera.plans.views import v_history, with_views
from tessera.session import scratch_path
from tessera.streaming import exact as X
from tessera.streaming import history as H

RESEND_DELAY = 3600  # seconds


def _write_log(spark, sf, copies: int = 1) -> str:
    src = scratch_path(spark, "history-log")
    h = v_history(spark, sf)
    for i in range(copies):
        # several files per copy so the stream sees several micro-batches
        h.repartition(4, "run_id").write.mode("append").parquet(src)
    return src


@register(
    "history_stream_summary",
    with_views(
        f"""SELECT run_id, strftime(epoch, '{TS_FMT_SQL}') AS epoch, round(avg(loss), 9) AS avg_loss,
  round(arg_max(lr, step), 9) AS last_lr, max(step) AS last_step, CAST(count(*) AS BIGINT) AS n_steps
FROM v_history GROUP BY run_id, epoch""",
        "v_history",
    ),
)
def q_history_stream_summary(spark, sf):
    """SS1: streaming running summary (update mode, idempotent batch sink)
    equals the batch summary once the log is consumed."""
    src = _write_log(spark, sf)
    out = scratch_path(spark, "history-summary")
    q = H.running_summary(H.history_stream(spark, src, max_files_per_trigger=1), out, out + "-ckpt")
    q.awaitTermination()
    s = H.read_running_summary(spark, out)
    return s.select(
        "run_id", F.date_format("epoch", "yyyy-MM-dd HH:mm:ss").alias("epoch"),
        F.round("avg_loss", 9).alias("avg_loss"), F.round("last_lr", 9).alias("last_lr"), "last_step", "n_steps",
    )


@register(
    "history_stream_append",
    with_views("SELECT run_id, step, round(loss, 9) AS loss FROM v_history", "v_history"),
)
def q_history_stream_append(spark, sf):
    """SS2: the log is sent twice; the exact append keeps one row per
    (run_id, step), with state for an hour and older rows held against the sink."""
    src = _write_log(spark, sf, copies=2)
    sink = scratch_path(spark, "history-sink")
    q = X.append_exactly(H.history_stream(spark, src, max_files_per_trigger=2), sink, sink + "-ckpt", RESEND_DELAY)
    q.awaitTermination()
    return X.read_sink(spark, sink, H.HISTORY_SCHEMA).select("run_id", "step", F.round("loss", 9).alias("loss"))
