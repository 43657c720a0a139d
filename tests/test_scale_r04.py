"""Disk of the edges of tracks: points are shuffled once, tracks are ranked whole, nothing is checkpointed."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.core import bucketed_rank


def brute(rows, radius):
    return sorted(
        (s, a, b) for s, a, p in rows for t, b, q in rows if s is not None and s == t and p and q and None not in p + q
        and sum((x - y) * (x - y) for x, y in zip(p, q)) <= radius * radius
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, path, users=6, frames=14):
    rng = random.Random(2)
    rows = [(u * 100 + f, f, u * 10 + u % 3, rng.uniform(0, 30), f'{{"k": {rng.randint(0, 30)}}}') for u in range(users) for f in range(frames)]
    rows.append((9999, 3, None, 1.0, '{"k": 1}'))
    df = spark.createDataFrame(rows, "event_id long, t long, user_id long, value double, props string")
    df.select("event_id", F.timestamp_seconds(F.col("t") * 40_000).alias("ts"), "user_id", "value", "props").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_radius_graph_of_points_on_lines_of_any_grid(spark):
    """Points in the middle and on the edges of cells of one, two and four radii, far out ones, repeated ones."""
    rows = [(0, k, [x, y]) for k, (x, y) in enumerate((x * 0.5, y * 0.5) for x in range(-5, 6) for y in range(-5, 6))]
    rows += [(0, 500, [1.0, 1.0]), (0, 500, [1.0, 1.0]), (1, 501, [1.0, 1.0]), (None, 502, [0.0, 0.0]), (0, 503, None), (0, 504, [1.0, None])]
    rows += [(2, 600, [1e18, 1.0]), (2, 601, [1e18, 1.5]), (2, 602, [1e300, 0.0]), (2, 603, [-3e15, 0.0]), (2, 604, [-3e15 - 1.0, 0.0])]
    points = spark.createDataFrame([*rows, (0, 700, [float("nan"), 0.0]), (0, 701, [float("inf"), 0.0])], "sample long, node long, pos array<double>")
    got = G.radius_graph(points.repartition(3), 1.0, dim=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 1.0)
    three = [(0, k, [x * 1.0, y * 1.0, z * 1.0]) for k, (x, y, z) in enumerate((x, y, z) for x in range(4) for y in range(4) for z in range(4))]
    got = G.radius_graph(spark.createDataFrame(three, "sample long, node long, pos array<double>"), 1.5, dim=3, loop=False)
    assert sorted(map(tuple, got.collect())) == [r for r in brute(three, 1.5) if r[1] != r[2]]


def test_radius_graph_shuffles_its_points_once(spark):
    rng = random.Random(1)
    rows = [(k % 3, k, [rng.uniform(0, 10), rng.uniform(0, 10)]) for k in range(400)]
    graph = G.radius_graph(spark.createDataFrame(rows, "sample long, node long, pos array<double>"), 1.0, dim=2)
    assert sorted(map(tuple, graph.collect())) == brute(rows, 1.0)
    final = plan(graph).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("- Exchange hashpartitioning") == 1


def test_edges_of_tracks_are_made_without_checkpoints(spark, tmp_path, monkeypatch):
    from tessera.plans import traj_queries as Q

    sf = events(spark, tmp_path)
    nodes = Q.materialize(Q._graph_nodes(spark, sf)).collect()
    written = []
    monkeypatch.setattr(Q, "materialize", lambda df: written.append(df) or df)
    edges = Q.q_traj_graph_edges(spark, sf)
    got = sorted((r.traj_id * 1000 + r.start, r.src, r.dst) for r in edges.collect())
    assert got == brute([(r.traj_id * 1000 + r.start, r.particle, list(r.recent)) for r in nodes], Q.G_RADIUS)
    assert len(got) > 3 * 8 and not written


def test_tracks_are_shuffled_once_up_to_their_windows(spark, tmp_path):
    from tessera.operators import trajectory as T
    from tessera.plans.views import v_traj

    track = v_traj(spark, events(spark, tmp_path))
    assert plan(T.materialize_windows(track, 7)).count("Exchange") == 1
    assert plan(T.acceleration(T.to_long(track))).count("Exchange") == 1
    assert track.where("particle is null").count() == 1


@pytest.mark.parametrize("whole", [1, 60, 10_000])
def test_only_large_groups_are_cut_into_buckets(spark, whole):
    rng = random.Random(3)
    data = [(k, None if k % 11 == 0 else "big" if k % 2 else str(k % 5), None if k % 17 == 0 else rng.randint(0, 40)) for k in range(400)]
    df = spark.createDataFrame(data, "id long, g string, v long").repartition(5)
    got = bucketed_rank(df, order=["v", "id"], bucket=F.floor(F.col("v") / 7), group_cols=["g"], size_col="n", whole=whole)
    assert ("Union" in plan(got)) == (whole < 400)
    bare = bucketed_rank(df, order=["v", "id"], bucket=F.floor(F.col("v") / 7), group_cols=["g"], whole=whole)
    group = Window.partitionBy("g")
    want = df.withColumn("rank", F.row_number().over(group.orderBy("v", "id"))).withColumn("n", F.count("*").over(group))
    key = lambda r: r[0]
    assert sorted(map(tuple, got.select("id", "g", "v", "rank", "n").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert sorted(map(tuple, bare.select("id", "rank").collect())) == sorted(map(tuple, want.select("id", "rank").collect()))
