"""Registered pipelines: data and metric handlers, displacements, batches, starts as rows."""

import random
import tempfile

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.core import bucketed_rank, fixed_batches
from tessera.operators.trajectory import bucketed_cumsum
from tessera.plans import registry as R
from tessera.sources import files, tensor_store


def test_every_pipeline_has_its_handlers():
    assert R.registered() == ["mesh_graph", "text_classifier", "trajectory_gns"]
    for name in R.registered():
        spec = R.get_pipeline(name)
        assert all(hasattr(spec.data, m) for m in ("load", "split", "size", "get")) and callable(spec.metrics)


def test_text_pipeline_end_to_end(spark):
    spec = R.get_pipeline("text_classifier")
    rows = [(k, None, f"t{k}", "net words\nhere" if k % 2 else "mesh solver", "ab"[k % 2]) for k in range(50)]
    path = tempfile.mkdtemp(prefix="text-") + "/csv"
    files.write_csv(spark.createDataFrame(rows, files.LABELLED_SCHEMA), path)
    df = spec.data.load(spark, path)
    train, test = spec.data.split(df)
    assert spec.data.size(df) == 50 and train.count() == 40 and test.count() == 10
    assert spec.data.get(df, 7).first().title == "t7" and spec.data.get(df, 700).count() == 0
    with_text = lambda d: d.withColumn("text", F.concat_ws(" ", "title", F.regexp_replace("description", "\n", " ")))
    model = spec.model(with_text(train))
    scored = model.probabilities(with_text(test), "id", "text").join(test, "id")
    scored = scored.select(F.col("tag").alias("y_true"), F.when(F.col("probability")[0] > 0.5, "a").otherwise("b").alias("y_pred"))
    overall = {r.scope: r for r in spec.metrics(scored).collect()}["overall"]
    assert overall.f1 == 1.0 and overall.num_samples == 10.0


def test_trajectory_and_mesh_pipelines(spark):
    spec = R.get_pipeline("trajectory_gns")
    path = tempfile.mkdtemp(prefix="traj-")
    rows = [(t, f, p, 0, [float(t), float(f)]) for t in range(4) for f in range(5) for p in range(2)]
    tensor_store.write_store(spark.createDataFrame(rows, tensor_store.ROW_SCHEMA), path)
    df = spec.data.load(spark, path)
    train, test = spec.data.split(df)
    assert spec.data.size(df) == 4 and spec.data.size(test) == 1 and train.count() == 30
    assert spec.data.get(df, 3).count() == 10
    long = spark.createDataFrame([(t, 0, f, d, 1.0, 1.0 + t) for t in (0, 1, 2) for f in (0, 1) for d in (0, 1)], "traj_id long, particle long, frame long, d int, x double, xp double")
    assert tuple(spec.metrics(long).first()) == ((0 + 2 + 8) / 3, 3)
    mesh = R.get_pipeline("mesh_graph")
    nodes = spark.createDataFrame([(s, s, 0, [0.0, 0.0], [float(s), 1.0], [0.0, 1.0]) for s in range(3)], "sample long, batch long, node_type long, velocity array<double>, y array<double>, pred array<double>")
    nodes.write.parquet(path + "/mesh")
    back = mesh.data.load(spark, path + "/mesh")
    assert [d.count() for d in mesh.data.split(back)] == [2, 1]
    assert mesh.metrics(back).first().num_batches == 3


def test_displacements_of_pairs_equal_joined_ones(spark):
    rng = random.Random(1)
    pts = spark.createDataFrame([(k % 2, k, [rng.random(), rng.random()]) for k in range(60)], "sample long, node long, pos array<double>")
    pairs = G.radius_graph(pts, 0.3, dim=2, positions=True)
    got, want = G.displacements(pairs, 0.3), G.edge_features(G.radius_graph(pts, 0.3, dim=2), pts, 0.3)
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(map(str, want.select(sorted(want.columns)).collect()))


def test_starts_as_rows_equal_windows(spark):
    """Ranks and running sums of groups with NULL keys, NULL values, repeated rows and columns of many types."""
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1]), rng.choice([None, *range(50)]), rng.choice([None, 0.5, 2.0]), [k], {"k": k}, (k,)) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, h int, o long, v double, l array<int>, m map<string,int>, s struct<x:int>")
    out = bucketed_cumsum(df, ["g", "h"], "o", ["v", "o"], ["vs", "os"], bucket_width=7).collect()
    assert len(out) == 500
    by = {}
    for r in out:
        by.setdefault((r.g, r.h), []).append(r)
    for group in by.values():
        group.sort(key=lambda r: (r.o is not None, r.o or 0, r.vs, r.os))
        assert max(r.os for r in group) == sum(r.o or 0 for r in group)
        assert abs(max(r.vs for r in group) - sum(r.v or 0 for r in group)) < 1e-9
    ranked = bucketed_rank(df, order=["o"], bucket=F.floor(F.col("o") / 7), group_cols=["g", "h"], size_col="n").collect()
    for key, group in by.items():
        mine = sorted((r["rank"], r.o is not None, r.o or 0) for r in ranked if (r.g, r.h) == key)
        assert [m[0] for m in mine] == [*range(1, len(group) + 1)] and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        assert {r.n for r in ranked if (r.g, r.h) == key} == {len(group)}
    plan = bucketed_rank(df, order=["o"], bucket=F.floor(F.col("o") / 7), group_cols=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_batches_follow_the_row_count(spark, monkeypatch):
    from tessera.operators import core

    monkeypatch.setattr(core, "BUCKET_ROWS", 3)
    sizes = sorted(r["count"] for r in fixed_batches(spark.range(1000), "id", 64).groupBy("batch").count().collect())
    assert sizes == [1000 - 15 * 64, *[64] * 15]
