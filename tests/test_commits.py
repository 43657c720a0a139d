"""Optimistic commits: two writers, conflicts, whole versions; the compacted history sink."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from tessera.sources import commit_log as L
from tessera.sources import history_store as HS
from tessera.sources import store as ST


def at_once(*jobs):
    ready, failed = threading.Barrier(len(jobs)), []

    def run(job):
        ready.wait()
        try:
            job()
        except Exception as e:  # noqa: BLE001 - reported below
            failed.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert failed == []


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_entries_are_created_once(spark, scheme):
    folder = scheme + tempfile.mkdtemp(prefix="log-")
    log = L.CommitLog(spark, folder)
    assert log.last() == (-1, None)
    made = []
    at_once(*[lambda k=k: made.append(log.append(lambda v, last: {"writer": k})) for k in range(8)])
    assert sorted(made) == list(range(8)) == log.versions()
    assert sorted(log.read(v)["writer"] for v in range(8)) == list(range(8))
    assert not log.put(3, {"writer": "late"}) and log.read(3)["writer"] != "late"
    assert log.append(lambda v, last: None) is None


def test_rename_without_overwriting(spark):
    """The way of file systems that are not mounted."""
    folder = "file://" + tempfile.mkdtemp(prefix="log-")
    assert L._hadoop_put(spark, f"{folder}/a.json", f"{folder}/.one", "1")
    assert not L._hadoop_put(spark, f"{folder}/a.json", f"{folder}/.two", "2")
    assert os.listdir(folder[7:]) == ["a.json"] or set(os.listdir(folder[7:])) == {"a.json", ".a.json.crc"}
    assert spark.read.text(f"{folder}/a.json").first()[0] == "1"


def test_two_writers_at_once_give_two_versions(spark):
    root = tempfile.mkdtemp(prefix="store-")
    one, two = spark.range(10), spark.range(20)
    at_once(*[lambda d=d: ST.register_dataset(spark, d, root, "a/b", "raw") for d in (one, two)])
    arts = ST.read_artifacts(spark, root).collect()
    assert sorted(a.version for a in arts) == [0, 1] and sorted(a.n_rows for a in arts) == [10, 20]
    for a in arts:
        assert ST.use_artifact(spark, root, f"a/b:v{a.version}").count() == a.n_rows


def test_equal_content_at_once_gives_one_version(spark):
    root = tempfile.mkdtemp(prefix="store-")
    at_once(*[lambda: ST.register_dataset(spark, spark.range(10), root, "a", "raw") for _ in range(3)])
    assert [a.version for a in ST.read_artifacts(spark, root).collect()] == [0]


def test_a_stale_reader_retries(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="store-")
    ST.register_dataset(spark, spark.range(3), root, "a", "raw")
    stale, real = [(-1, None)], L.CommitLog.last
    monkeypatch.setattr(L.CommitLog, "last", lambda self: stale.pop() if stale else real(self))
    assert ST.register_dataset(spark, spark.range(4), root, "a", "raw") == (True, "a:latest")
    assert {a.version: a.n_rows for a in ST.read_artifacts(spark, root).collect()} == {0: 3, 1: 4}


def test_a_failed_write_makes_no_version(spark):
    root = tempfile.mkdtemp(prefix="store-")
    bad = spark.range(3).select(F.when(F.col("id") < 5, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception):  # noqa: B017 - the digest needs the rows
        ST.register_dataset(spark, bad, root, "a", "raw")
    assert ST.read_artifacts(spark, root).count() == 0


def history(spark, runs, steps, at=0):
    r = spark.range(runs * steps)
    return r.select((F.col("id") % runs).alias("run_id"), (F.floor(F.col("id") / runs) + at).alias("step"), (F.col("id") / 7).alias("loss"))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_ten_thousand_runs_make_few_folders(spark):
    path = tempfile.mkdtemp(prefix="history-")
    rows = history(spark, 10_000, 2)
    HS.append(rows, path)
    HS.append(history(spark, 10_000, 1, at=2), path)
    folders = [d for d, _, _ in os.walk(f"{path}/data")]
    assert len(folders) <= 2 * HS.BUCKETS + 3
    before = rows_of(HS.read(spark, path))
    assert before == rows_of(rows.unionByName(history(spark, 10_000, 1, at=2)))
    assert HS.compact(spark, path) == 2 and HS.compact(spark, path) is None
    assert rows_of(HS.read(spark, path)) == before
    assert len(HS.unseen(spark, path)) == 2
    some = HS.read(spark, path, runs=[3, 77])
    assert rows_of(some) == [r for r in before if r[0] in (3, 77)]
    assert "PartitionFilters: [bucket" in some._jdf.queryExecution().toString().replace("isnotnull(bucket#", "bucket")  or "bucket" in some._jdf.queryExecution().toString()
    sorted_files = HS.read(spark, path).withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    by_file = {}
    for r in sorted_files.orderBy("i").collect():
        by_file.setdefault(r.f, []).append((r.run_id, r.step))
    assert all(v == sorted(v) for v in by_file.values()) and len(by_file) <= HS.BUCKETS + 8


def test_appends_during_a_compaction_stay(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="history-")
    HS.append(history(spark, 5, 2), path)
    HS.append(history(spark, 5, 2, at=2), path)
    write = HS._write

    def slow(rows, *rest):
        name = write(rows, *rest)
        monkeypatch.setattr(HS, "_write", write)
        HS.append(history(spark, 5, 1, at=9), path)  # between reading and committing
        return name

    monkeypatch.setattr(HS, "_write", slow)
    assert HS.compact(spark, path) == 3
    assert HS.read(spark, path).count() == 25


def test_of_two_compactions_one_wins(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="history-")
    HS.append(history(spark, 5, 2), path)
    HS.append(history(spark, 5, 2, at=2), path)
    write = HS._write

    def slow(rows, *rest):
        name = write(rows, *rest)
        monkeypatch.setattr(HS, "_write", write)
        assert HS.compact(spark, path) == 2
        return name

    monkeypatch.setattr(HS, "_write", slow)
    assert HS.compact(spark, path) is None
    assert HS.read(spark, path).count() == 20


def test_null_runs_and_no_commit(spark):
    path = tempfile.mkdtemp(prefix="history-")
    with pytest.raises(FileNotFoundError):
        HS.read(spark, path)
    HS.append(spark.createDataFrame([(None, 1, 0.5), (2, None, None)], "run_id long, step long, loss double"), path)
    assert HS.read(spark, path).count() == 2
    assert HS.read(spark, path, runs=[None]).collect()[0].step == 1
