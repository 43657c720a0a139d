"""Flat-tensor source on the reference single-file layout, behavioural checks,
streaming equals batch, the dataset store."""

import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import models as MD
from tessera.operators.runs import epoch_summary
from tessera.plans.views import v_history
from tessera.sources import flat_tensor as FT


def _write_reference_layout(root, split="test"):
    rng = np.random.default_rng(0)
    trajs = {0: (5, 3, 2), 1: (4, 2, 2)}
    pos_parts, type_parts, ctx_parts, manifest = [], [], [], {}
    pos_off = type_off = ctx_off = 0
    for t, (T, N, dim) in trajs.items():
        pos = rng.normal(size=(T, N, dim)).astype(np.float32)
        types = np.arange(N, dtype=np.int64) + 10 * t
        ctx = rng.normal(size=(T, 1)).astype(np.float32)
        manifest[str(t)] = {
            "position": {"offset": pos_off, "shape": [T, N, dim]},
            "particle_type": {"offset": type_off},
            "step_context": {"offset": ctx_off, "shape": [T, 1]},
        }
        pos_parts.append(pos.ravel())
        type_parts.append(types)
        ctx_parts.append(ctx.ravel())
        pos_off += pos.size
        type_off += types.size
        ctx_off += ctx.size
    np.concatenate(pos_parts).tofile(os.path.join(root, f"{split}_position.dat"))
    np.concatenate(type_parts).tofile(os.path.join(root, f"{split}_particle_type.dat"))
    np.concatenate(ctx_parts).tofile(os.path.join(root, f"{split}_step_context.dat"))
    with open(os.path.join(root, f"{split}_offset.json"), "w") as f:
        json.dump(manifest, f)
    return trajs, np.concatenate(pos_parts)


def test_flat_tensor_reference_layout(spark):
    root = tempfile.mkdtemp(prefix="flat-")
    trajs, flat = _write_reference_layout(root)
    pos = FT.read_test_split(spark, root)
    assert pos.count() == sum(T * N for T, N, _ in trajs.values())
    assert abs(pos.agg(F.sum(F.aggregate("pos", F.lit(0.0), lambda a, x: a + x))).first()[0] - float(flat.astype(np.float64).sum())) < 1e-6
    # row-major [T, N, dim]: trajectory 1, frame 2, particle 1
    T0, N0, d0 = trajs[0]
    off = T0 * N0 * d0 + (2 * 2 + 1) * 2
    row = pos.where("traj_id = 1 AND frame = 2 AND particle = 1").first()
    assert row.pos == [float(flat[off]), float(flat[off + 1])]
    full = FT.read_trajectories(spark, root, "test")
    assert full.where(F.col("particle_type").isNull() | F.col("context").isNull()).count() == 0
    types = FT.read_particle_types(spark, root, "test").orderBy("traj_id", "particle").collect()
    assert [r.particle_type for r in types] == [0, 1, 2, 10, 11]


def test_many_trajectories_make_few_files_and_tasks(spark):
    """2,000 trajectories of 3 chunks each: files and input partitions do not grow with them."""
    root = tempfile.mkdtemp(prefix="flat-")
    rows = spark.range(2000 * 70).select(
        F.expr("cast(id % 2000 as int)").alias("traj_id"), F.expr("cast(id div 2000 as int)").alias("frame"), F.lit(0).alias("particle"),
        F.expr("array(cast(id as double), id * 0.5D)").alias("pos"),
    )
    types = rows.select("traj_id", "particle", (F.col("traj_id") % 9).cast("long").alias("particle_type")).distinct()
    FT.write_trajectories(rows, root, "train", frames_per_chunk=32, particle_type=types)
    assert len(os.listdir(os.path.join(root, "train_position"))) < 100
    back = FT.read_trajectories(spark, root, "train")
    assert FT.read_positions(spark, root, "train").rdd.getNumPartitions() < 200
    wrong = (F.col("particle_type") != F.col("traj_id") % 9) | (F.col("pos")[0] != F.col("frame") * 2000 + F.col("traj_id")) | (F.col("pos")[1] * 2 != F.col("pos")[0])
    assert back.count() == back.select("traj_id", "frame").distinct().count() == 140_000
    assert back.where(wrong | F.col("particle_type").isNull()).count() == 0


def test_chunks_of_several_particles_and_frames_apart(spark):
    root = tempfile.mkdtemp(prefix="flat-")
    rows = [(t, f, p, [float(t), float(f), p * 0.5]) for t in (3, 1) for f in range(25) for p in range(4)]
    df = spark.createDataFrame(rows, "traj_id int, frame int, particle int, pos array<double>").repartition(5)
    FT.write_trajectories(df, root, "test", frames_per_chunk=10)
    back = FT.read_positions(spark, root, "test", frames_per_partition=4)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    gap = df.where("frame <> 4 OR particle <> 2")
    with pytest.raises(Exception, match="not dense"):
        FT.write_trajectories(gap, tempfile.mkdtemp(prefix="flat-"), "test", frames_per_chunk=10)


def test_behavioral_checks(spark):
    rows = [
        ("Word embeddings help a parser read sentences.", "natural-language-processing"),
        ("A small tagger for parts of speech.", "natural-language-processing"),
        ("Summaries of long reports by a language network.", "natural-language-processing"),
        ("Translation between rare languages with few sentences.", "natural-language-processing"),
        ("Finding road signs in camera pictures.", "computer-vision"),
        ("Watching deployed services for drift.", "mlops"),
        ("A solver for heat flow on meshes.", "other"),
    ]
    train = spark.createDataFrame([(i, t.lower(), g) for i, (t, g) in enumerate(rows)], "id long, text string, tag string")
    model, history = MD.fit_text_classifier(train, max_iter=50)
    assert history.count() > 1
    cases = spark.createDataFrame(
        [
            (1, "invariance", rows[0][0].lower(), "word embeddings let a parser read sentences.", None),
            (2, "directional", rows[1][0].lower(), None, "natural-language-processing"),
            (3, "directional", rows[4][0].lower(), None, "computer-vision"),
            (4, "directional", rows[2][0].lower(), None, "natural-language-processing"),
            (5, "mft", rows[3][0].lower(), None, "natural-language-processing"),
            (6, "mft", rows[5][0].lower(), None, "mlops"),
            (7, "mft", rows[6][0].lower(), None, "other"),
        ],
        "case_id long, kind string, input_a string, input_b string, expected string",
    )
    out = {r.case_id: r for r in MD.behavioral_checks(model, cases, fallback="other").collect()}
    assert len(out) == 7
    assert all(out[i].passed for i in (2, 3, 4, 5, 6, 7))
    assert out[1].pred_a is not None and out[1].pred_b is not None


def test_streaming_summary_equals_batch(spark):
    from tessera.session import scratch_path
    from tessera.streaming import history as H

    src = scratch_path(spark, "hist-src")
    v_history(spark, SF_SMALL).repartition(3).write.parquet(src)
    out = scratch_path(spark, "hist-out")
    H.running_summary(H.history_stream(spark, src, max_files_per_trigger=1), out, out + "-ckpt").awaitTermination()
    stream = H.read_running_summary(spark, out)
    batch = epoch_summary(v_history(spark, SF_SMALL))
    cols = ["run_id", "epoch", "avg_loss", "last_lr", "last_step", "n_steps"]
    a = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in stream.select(*cols).collect())
    b = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in batch.select(*cols).collect())
    assert a == b


def test_model_artifact_versions_and_resolution(spark):
    from tessera.session import scratch_path
    from tessera.sources import store as ST

    root = scratch_path(spark, "store-test")
    train = spark.createDataFrame([(0, "a b c", "x"), (1, "d e f", "y")], "id long, text string, tag string")
    model, _ = MD.fit_text_classifier(train, max_iter=5)
    p0 = ST.log_model(spark, model, root, "clf")
    p1 = ST.log_model(spark, model, root, "clf")
    assert p0 != p1
    arts = ST.versions_with_aliases(ST.read_artifacts(spark, root)).orderBy("version").collect()
    assert [a.version for a in arts] == [0, 1] and "latest" in arts[1].aliases
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ok, ref = ST.register_dataset(spark, docs, root, "docs", "raw_data")
    assert ok and ref == "docs:latest"
    assert ST.use_artifact(spark, root, "docs:latest").count() == docs.count()
    ST.register_dataset(spark, docs, root, "docs", "raw_data")  # same digest: no new version
    assert ST.read_artifacts(spark, root).where("name = 'docs'").count() == 1


def test_store_keeps_versions_on_a_uri_root(spark):
    from tessera.session import scratch_path
    from tessera.sources import store as ST

    root = "file://" + scratch_path(spark, "store-uri")
    first = spark.createDataFrame([("x", None), ("y", "z")], "a string, b string")
    second = spark.createDataFrame([(None, "x"), ("y", "z")], "a string, b string")
    ST.register_dataset(spark, first, root, "d", "raw_data")
    ST.register_dataset(spark, second, root, "d", "raw_data")
    assert {r.version for r in ST.read_artifacts(spark, root).collect()} == {0, 1}
    assert {tuple(r) for r in ST.use_artifact(spark, root, "d:v0").collect()} == {("x", None), ("y", "z")}
    assert {tuple(r) for r in ST.use_artifact(spark, root, "d:latest").collect()} == {(None, "x"), ("y", "z")}


def test_map_groups_and_map_batches(spark):
    from tessera.operators.udf import map_batches, map_groups

    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0)], "k long, v double")

    def demean(pdf):
        pdf["v"] = pdf["v"] - pdf["v"].mean()
        return pdf

    out = {(r.k, r.v) for r in map_groups(df, ["k"], demean, "k long, v double").collect()}
    assert out == {(1, -0.5), (1, 0.5), (2, 0.0)}
    doubled = map_batches(df, lambda pdf, f: pdf.assign(v=pdf["v"] * f), "k long, v double", f=2.0)
    assert sorted(r.v for r in doubled.collect()) == [2.0, 4.0, 10.0]


def test_manifest_table(spark):
    root = tempfile.mkdtemp(prefix="flat-")
    trajs, _ = _write_reference_layout(root)
    m = {r.traj_id: r for r in FT.manifest_table(spark, root, "test").collect()}
    assert set(m) == set(trajs)
    assert (m[1].T, m[1].N, m[1].dim) == trajs[1]
    assert m[1].position_offset == 5 * 3 * 2 and m[0].context_dim == 1
