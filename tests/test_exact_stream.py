"""Exact appends of a re-sent log: restarts, resends, freed state, late rows."""

import datetime as dt
import math
import time

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.streaming import exact as X
from tessera.streaming import history as H

DELAY = 6


def send(spark, log, steps, logged, run=1, loss=0.5):
    rows = [(run, None, s, loss, 0.1, logged) for s in steps]
    spark.createDataFrame(rows, H.HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def consume(spark, log, sink):
    """A restart: a new query on the same checkpoint reads what has come since."""
    q = X.append_exactly(H.history_stream(spark, log), sink, sink + "-ckpt", DELAY)
    q.awaitTermination()
    return [p for p in q.recentProgress if p["numInputRows"] or p["stateOperators"]][-1]["stateOperators"][0]


def steps_of(spark, sink):
    return sorted(r.step for r in X.read_sink(spark, sink, H.HISTORY_SCHEMA).collect())


def test_restarts_resends_and_freed_state(spark):
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "sink")
    began = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    send(spark, log, [*range(40), *range(20)], began)  # twice in one batch
    consume(spark, log, sink)
    assert steps_of(spark, sink) == [*range(40)]
    send(spark, log, range(10, 60), began)  # sent again after a restart
    state = consume(spark, log, sink)
    assert steps_of(spark, sink) == [*range(60)]
    assert state["numRowsTotal"] == 1  # steps 0 to 59 of one run: one span
    time.sleep(DELAY + 1)
    send(spark, log, [5000], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    state = consume(spark, log, sink)
    assert state["numRowsTotal"] == 1 and state["numRowsRemoved"] >= 1  # the span of step 5000 alone
    send(spark, log, range(55, 65), began)  # later than the delay: held against the sink
    consume(spark, log, sink)
    assert steps_of(spark, sink) == [*range(65), 5000]


def test_old_logs_are_held_against_the_sink(spark):
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "sink")
    for day in (1, 2, 3):
        send(spark, log, range(day * 10, day * 10 + 10), dt.datetime(2020, 1, day, 12))
        consume(spark, log, sink)
    send(spark, log, range(10, 40), dt.datetime(2020, 1, 2, 12))  # days of their own for steps 10 to 19 and 30 to 39
    send(spark, log, range(20, 23), dt.datetime(2020, 1, 2, 12))
    consume(spark, log, sink)
    assert [s for s in steps_of(spark, sink) if 20 <= s < 30] == [*range(20, 30)]


def test_values_survive_and_nulls_pass(spark):
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "sink")
    at = dt.datetime(2021, 3, 28, 1, 30, 0, 123456)
    rows = [(2**62 + 1, at, 2**61 + 3, math.nan, None, at), (7, None, 1, math.inf, -0.0, None), (None, None, 1, 1.0, 1.0, at), (None, None, 1, 1.0, 1.0, at), (7, None, None, 2.0, 1.0, at)]
    spark.createDataFrame(rows, H.HISTORY_SCHEMA).write.parquet(log)
    consume(spark, log, sink)
    got = X.read_sink(spark, sink, H.HISTORY_SCHEMA).collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(rows, H.HISTORY_SCHEMA).collect()))


def test_a_batch_that_runs_again_writes_the_same(spark):
    """The sink already has the folder of the batch, as after a failure between write and commit."""
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "sink")
    send(spark, log, range(5), dt.datetime(2020, 5, 1))
    spark.read.parquet(log).withColumn("day", F.to_date("logged_at")).where("step < 3").write.partitionBy("day").parquet(f"{sink}/batch_id=0")
    consume(spark, log, sink)
    assert steps_of(spark, sink) == [*range(5)]
