"""Exact append of a log whose rows are sent again (SS2).

A row is sent once and, within ``resend_delay`` of that, any number of times
more. State holds the steps of that span of time alone: per (run, span of
steps) the steps seen and when each may be forgotten; a timer frees what is
due. A row that was logged longer ago than the delay may have been sent before
its state was freed, so it is held against the sink instead, of which only the
days of such rows are read. A row logged later than that cannot be there unless
the state knows it. Both together lose nothing and repeat nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tessera.sources.store import path_exists

#: Steps of a run that share one state.
SPAN = 1024
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _forget_and_learn(delay_ms: int):
    def update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        known = {s: t for s, t in zip(*state.get) if t > now} if state.exists else {}
        if not state.hasTimedOut:
            rows = pd.concat(list(pdfs)).sort_values(["logged", "payload"], kind="stable").drop_duplicates("step")
            new = rows[~rows["step"].isin(list(known))]
            known.update(dict.fromkeys(new["step"].tolist(), now + delay_ms))
            yield new[["payload"]]
        if known:
            state.update((list(known), list(known.values())))
            state.setTimeoutDuration(max(1, min(known.values()) - now))
        elif state.exists:
            state.remove()

    return update


def dedup_resends(stream: DataFrame, resend_delay: int, *, run: str = "run_id", step: str = "step", time: str = "logged_at") -> DataFrame:
    """The rows of a stream without those of a (run, step) seen within the last ``resend_delay`` seconds.

    Of several in one batch the one logged first stays. Rows travel as JSON
    text, so NULL, NaN and large numbers come out as they went in. Rows with a
    NULL run or step cannot be told apart and all pass.
    """
    schema = stream.schema
    named = stream.where(F.col(run).isNotNull() & F.col(step).isNotNull())
    packed = named.select(
        F.col(run).cast("string").alias("run"),
        F.floor(F.col(step) / F.lit(SPAN)).alias("span"),
        F.col(step).cast("long").alias("step"),
        F.coalesce(F.unix_millis(time), F.lit(0)).alias("logged"),
        F.to_json(F.struct(*schema.names), _JSON).alias("payload"),
    )
    kept = packed.groupBy("run", "span").applyInPandasWithState(
        _forget_and_learn(int(resend_delay * 1000)),
        "payload string",
        "steps array<bigint>, until array<bigint>",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    back = kept.select(F.from_json("payload", schema, _JSON).alias("r")).select("r.*")
    return back.unionByName(stream.where(F.col(run).isNull() | F.col(step).isNull()))


def read_sink(spark: SparkSession, sink: str, schema: StructType | str) -> DataFrame:
    """All rows that were appended to ``sink``."""
    made = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not path_exists(spark, sink):
        return spark.createDataFrame([], made)
    extra = StructType.fromDDL("batch_id long, day date")
    return spark.read.schema(StructType([*made.fields, *extra.fields])).parquet(sink).select(*made.names)


def append_exactly(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    resend_delay: int,
    *,
    run: str = "run_id",
    step: str = "step",
    time: str = "logged_at",
    available_now: bool = True,
) -> StreamingQuery:
    """Append each (run, step) of ``stream`` once to ``sink``, folders of parquet by batch and day.

    A batch that is run again after a failure writes its own folder anew and is
    not held against it. A NULL ``time`` counts as long ago.
    """
    schema = stream.schema
    spark = stream.sparkSession

    def write(rows: DataFrame, batch_id: int) -> None:
        old = F.coalesce(F.col(time) < F.current_timestamp() - F.expr(f"INTERVAL {int(resend_delay)} SECONDS"), F.lit(True))
        rows = rows.withColumn("day", F.to_date(time)).withColumn("__old", old).persist()
        try:
            days = [r[0] for r in rows.where("__old").select("day").distinct().collect()]
            if days and path_exists(rows.sparkSession, sink):
                extra = StructType.fromDDL("batch_id long, day date")
                there = rows.sparkSession.read.schema(StructType([*schema.fields, *extra.fields])).parquet(sink)
                dated = F.col("day").isin([d for d in days if d is not None])
                there = there.where((F.col("batch_id") != batch_id) & (dated | F.col("day").isNull() if None in days else dated))
                seen = there.select(F.col(run).alias("__run"), F.col(step).alias("__step")).distinct()
                same = F.col("__old") & (F.col(run) == F.col("__run")) & (F.col(step) == F.col("__step"))
                out = rows.join(seen, same, "left_anti")
            else:
                out = rows
            out.drop("__old").write.mode("overwrite").partitionBy("day").parquet(f"{sink}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    kept = dedup_resends(stream, resend_delay, run=run, step=step, time=time)
    w = kept.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if not available_now:
        return w.trigger(processingTime="10 seconds").start()
    # timers would ask for one batch without data after another, and the query would never end
    before = spark.conf.get(_NO_DATA)
    spark.conf.set(_NO_DATA, "false")
    try:
        return w.trigger(availableNow=True).start()  # takes the settings of this moment
    finally:
        spark.conf.set(_NO_DATA, before)
