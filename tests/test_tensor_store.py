"""Trajectory tensors: round trips on URIs, commits, aborts, ranges, the flat layout."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import tensor_store as S
from test_sources_models import _write_reference_layout

SCHEMA = "traj_id long, frame long, particle long, particle_type long, pos array<double>"


def tracks():
    """Three trajectories with ids that do not start at 0, and frames that do not either."""
    rows = []
    for traj, ids, frames in ((1, [5, 9, 40], range(3, 40)), (2, [7], range(0, 5)), (12, [0, 1], range(64, 90))):
        for f in frames:
            for p in ids:
                rows.append((traj, f, p, p % 4 + traj, [float(np.float32(traj + f / 7)), float(np.float32(p / 3)), -1.0]))
    return rows


def rows_of(df):
    return sorted((r.traj_id, r.frame, r.particle, r.particle_type, list(r.pos)) for r in df.collect())


def files_of(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_round_trip(spark, scheme):
    folder = scheme + tempfile.mkdtemp(prefix="store-")
    S.write_store(spark.createDataFrame(tracks(), SCHEMA), folder, frames_per_chunk=8)
    assert rows_of(S.read_store(spark, folder)) == sorted(tracks())
    index = S.store_index(spark, folder)
    assert index.where("frame0 > 0 AND types_at IS NOT NULL").count() > 5
    small = S.read_index(index, bytes_per_read=40)  # one or two frames at a time
    assert S.byte_ranges(index, 40).count() > index.count() and rows_of(small) == sorted(tracks())


def test_appended_splits_and_writes(spark):
    folder = tempfile.mkdtemp(prefix="store-")
    df = spark.createDataFrame(tracks(), SCHEMA)
    S.write_store(df.where("traj_id = 1"), folder)
    S.write_store(df.where("traj_id = 2"), folder)
    S.write_store(df.where("traj_id = 12"), folder, split="test")
    assert rows_of(S.read_store(spark, folder)) == [r for r in sorted(tracks()) if r[0] < 12]
    assert rows_of(S.read_store(spark, folder, "test")) == [r for r in sorted(tracks()) if r[0] == 12]
    S.write_store(df.where("false"), folder, split="none")
    assert S.read_store(spark, folder, "none").collect() == []


@pytest.mark.parametrize(
    "bad",
    [(1, 41, 5, 6, [0.0, 0.0, 0.0]), (1, 39, 41, 6, [0.0, 0.0, 0.0]), (1, 39, 5, 6, [0.0, 0.0, 0.0]), (12, 90, 0, 99, [0.0, 0.0])],
    ids=["gap", "particle", "twice", "length"],
)
def test_a_failed_task_leaves_no_file(spark, bad):
    folder = tempfile.mkdtemp(prefix="store-")
    with pytest.raises(Exception):  # noqa: B017 - Spark wraps what the task raised
        S.write_store(spark.createDataFrame([*tracks(), bad], SCHEMA), folder, frames_per_chunk=50)
    assert files_of(folder) == []


def test_uncommitted_parts_are_not_read(spark):
    folder = tempfile.mkdtemp(prefix="store-")
    df = spark.createDataFrame(tracks(), SCHEMA)
    S.write_store(df.where("traj_id = 1"), folder)
    writer = S.TrajectoryWriter({"path": folder})
    table = df.where("traj_id = 2").withColumn("chunk", F.lit(0).cast("long")).toArrow()
    message = writer.write(iter(table.to_batches()))  # a task whose job has not ended
    assert message.blocks == 1 and rows_of(S.read_store(spark, folder)) == [r for r in sorted(tracks()) if r[0] == 1]
    writer.abort([message, None])
    assert not any(message.part in f for f in files_of(folder))
    assert rows_of(S.read_store(spark, folder)) == [r for r in sorted(tracks()) if r[0] == 1]


def test_flat_layout(spark):
    root = tempfile.mkdtemp(prefix="flat-")
    trajs, flat = _write_reference_layout(root)
    got = {(r.traj_id, r.frame, r.particle): (r.particle_type, r.pos) for r in S.read_flat(spark, f"file://{root}", "test").collect()}
    assert len(got) == sum(t * n for t, n, _ in trajs.values())
    t, n, d = trajs[0]
    at = t * n * d + (2 * 2 + 1) * 2
    assert got[1, 2, 1] == (11, [float(flat[at]), float(flat[at + 1])])
    whole = S.read_flat_trajectories(spark, root, "test")
    assert whole.count() == len(got) and whole.where("context IS NULL OR size(context) <> 1").count() == 0
    assert S.read_flat_context(spark, root, "test").count() == sum(t for t, _, _ in trajs.values())
    os.truncate(os.path.join(root, "test_position.dat"), 8)
    with pytest.raises(Exception, match="bytes at"):
        S.read_flat(spark, root, "test").collect()
