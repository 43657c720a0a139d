"""The metric-history sink: buckets of runs, compacted files, committed writes (SC12).

``<path>/data/write=<id>/bucket=<b>/*.parquet`` and a commit log. An entry adds
folders and takes others out; what a reader sees is what entries up to the last
one leave. Appends never conflict in content, so they take the next free number.
A compaction replaces the folders that it has read by one whose files are sorted
by run and step, and gives up if another compaction took one of them first.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql import types as T

from tessera.sources.commit_log import CommitLog

#: Buckets of runs: the folders of a write, however many runs it has.
BUCKETS = 64


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}/_log")


def bucket_of(run: Column) -> Column:
    """A NULL run has a bucket too."""
    return F.pmod(F.xxhash64(run), F.lit(BUCKETS)).cast("int")


def _write(rows: DataFrame, path: str, run: str, step: str) -> str:
    """Rows in a folder of their own that no entry names yet."""
    name = f"write={uuid.uuid4().hex}"
    dealt = rows.withColumn("bucket", bucket_of(F.col(run)))
    # rebalance joins small partitions and splits large ones, so a run with a third of all rows fills several files
    laid = dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", run, step)
    laid.write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/data/{name}")
    return name


def _live(log: CommitLog) -> tuple[list[str], str | None]:
    """Folders in sight, and the schema of the first write."""
    live, schema = [], None
    for version in log.versions():
        entry = log.read(version)
        live = [f for f in live if f not in set(entry["remove"])] + entry["add"]
        schema = schema or entry["schema"]
    return live, schema


def _entry(rows: DataFrame, add: list[str], remove: list[str]) -> dict:
    at = dt.datetime.now(dt.timezone.utc).isoformat()
    return {"add": add, "remove": remove, "schema": rows.schema.json(), "at": at}


def append(rows: DataFrame, path: str, *, run: str = "run_id", step: str = "step") -> int:
    """Append ``rows``; the version of the commit. Rows are seen at once or not at all."""
    name = _write(rows, path, run, step)
    return _log(rows.sparkSession, path).append(lambda version, last: _entry(rows, [name], []))


def read(spark: SparkSession, path: str, *, run: str = "run_id", runs: list | None = None) -> DataFrame:
    """The rows of all commits. With ``runs`` only the buckets of these runs are read."""
    live, schema = _live(_log(spark, path))
    if not live:
        raise FileNotFoundError(f"{path}: nothing was committed")
    import json

    made = StructType.fromJson(json.loads(schema))
    root = f"{path.rstrip('/')}/data"
    full = StructType([*made.fields, StructField("write", T.StringType()), StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/{f}" for f in live])
    if runs is not None:
        kind = made[run].dataType
        wanted = spark.createDataFrame([(r,) for r in runs], StructType([StructField(run, kind)]))
        buckets = [r[0] for r in wanted.select(bucket_of(F.col(run))).distinct().collect()]  # BUCKETS numbers at most
        found = F.col(run).isin([r for r in runs if r is not None])
        rows = rows.where(F.col("bucket").isin(buckets) & (found | F.col(run).isNull() if None in runs else found))
    return rows.select(*made.names)


def compact(spark: SparkSession, path: str, *, run: str = "run_id", step: str = "step") -> int | None:
    """Rewrite all folders in sight as one, sorted by run and step; None if there was nothing to do, or another
    compaction was faster. Folders out of sight stay on disk for those who still read them; see :func:`unseen`."""
    log = _log(spark, path)
    sources, _ = _live(log)
    if len(sources) < 2:
        return None
    rows = read(spark, path, run=run)
    name = _write(rows, path, run, step)

    def decide(version: int, last: dict | None) -> dict | None:
        now, _ = _live(log)
        return _entry(rows, [name], sources) if set(sources) <= set(now) else None

    return log.append(decide)


def unseen(spark: SparkSession, path: str) -> list[str]:
    """Folders that entries took out: free to delete once nobody reads an older version."""
    log = _log(spark, path)
    live, _ = _live(log)
    return sorted({f for v in log.versions() for f in log.read(v)["remove"]} - set(live))
