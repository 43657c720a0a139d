"""Property and plan tests (radius graph, ranks, metrics, integration,
scatter totals, normalization, registry, quality helpers)."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tessera.functions.arrays import normalize, unnormalize
from tessera.operators import graph as G
from tessera.operators import trajectory as T
from tessera.operators.core import hash_rank
from tessera.operators.metrics import slice_metrics
from tessera.operators.runs import EmptyResultError, assert_non_empty, best_run
from tessera.plans import registry
from tessera.plans.views import POINT_RADIUS, v_graph_edges, v_graph_nodes, v_points, v_runs, v_text, v_traj


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_radius_graph_symmetric_with_self_loops_and_no_cartesian(spark):
    pts = v_points(spark, SF_CHECK)
    e = G.radius_graph(pts, POINT_RADIUS, dim=2)
    plan = _plan(e)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    pairs = {(r.sample, r.src, r.dst) for r in e.collect()}
    assert all((s, d, a) in pairs for (s, a, d) in pairs)
    assert {(r.sample, r.node) for r in pts.collect()} == {(s, a) for (s, a, d) in pairs if a == d}


def test_radius_graph_matches_brute_force(spark):
    rows = v_points(spark, SF_SMALL).collect()
    want = set()
    for a in rows:
        for b in rows:
            if a.sample == b.sample and (a.pos[0] - b.pos[0]) ** 2 + (a.pos[1] - b.pos[1]) ** 2 <= POINT_RADIUS**2:
                want.add((a.sample, a.node, b.node))
    got = {(r.sample, r.src, r.dst) for r in G.radius_graph(v_points(spark, SF_SMALL), POINT_RADIUS, dim=2).collect()}
    assert got == want


def test_hash_rank_equals_plain_row_number_and_has_no_single_partition_window(spark):
    vt = v_text(spark, SF_CHECK).select("id", "tag")
    ranked = hash_rank(vt, "id", 99, group_cols=["tag"], digits=1)
    plan = _plan(ranked)
    assert "SinglePartition" not in plan
    w = Window.partitionBy("tag").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(":99"))), "id")
    plain = vt.withColumn("r2", F.row_number().over(w))
    j = ranked.join(plain, ["id", "tag"])
    assert j.where(F.col("rank") != F.col("r2")).count() == 0
    assert j.count() == vt.count()


def test_micro_metrics_equal_accuracy(spark):
    df = spark.createDataFrame(
        [(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "c", "a")], "id long, y_true string, y_pred string"
    )
    m = slice_metrics(df, {"all": F.lit(True)}).first()
    assert m.precision == m.recall == m.f1 == pytest.approx(0.5)
    assert m.num_samples == 4


def test_integration_inverts_second_difference(spark):
    long = T.to_long(v_traj(spark, SF_SMALL))
    acc = T.acceleration(long).withColumn("frame", F.col("frame") + 1)
    rolled = T.integrate(long, acc, seed_frames=6)
    j = rolled.withColumnRenamed("x", "xr").join(long, T.KEYS + ["frame", "d"])
    assert j.count() == long.count()
    assert j.agg(F.max(F.abs(F.col("xr") - F.col("x")))).first()[0] < 1e-6


def test_bucketed_cumsum_equals_window_sum(spark):
    long = T.to_long(v_traj(spark, SF_SMALL))
    got = T.bucketed_cumsum(long, T.KEYS + ["d"], "frame", "x", "cs", bucket_width=4)
    w = Window.partitionBy(*T.KEYS, "d").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    j = got.join(long.withColumn("cs2", F.sum("x").over(w)), T.KEYS + ["frame", "d", "x"])
    assert j.agg(F.max(F.abs(F.col("cs") - F.col("cs2")))).first()[0] < 1e-6


def test_scatter_sum_totals_equal_edge_totals(spark):
    part, sup = v_graph_nodes(spark, SF_SMALL)
    edges = v_graph_edges(spark, SF_SMALL)
    out = G.scatter_sum(edges, sup, value="attr", width=2, to="dst")
    joined_edges = edges.join(sup.select(F.col("node").alias("dst")), "dst", "left_semi")
    want = joined_edges.agg(F.sum(F.col("attr")[0]), F.count(F.lit(1))).first()
    got = out.agg(F.sum(F.col("aggr")[0]), F.sum("degree")).first()
    assert got[0] == pytest.approx(want[0]) and got[1] == want[1]


def test_normalize_roundtrip(spark):
    df = spark.createDataFrame([([1.0, -2.0], [0.5, 1.0], [2.0, 4.0])], "x array<double>, m array<double>, s array<double>")
    back = df.select(unnormalize(normalize("x", "m", "s"), "m", "s").alias("b")).first().b
    assert back == pytest.approx([1.0, -2.0])


def test_assert_non_empty_and_best_run(spark):
    runs = v_runs(spark, SF_SMALL)
    assert assert_non_empty(best_run(runs, "1-URGENT"), "1-URGENT").count() == 1
    with pytest.raises(EmptyResultError):
        assert_non_empty(best_run(runs, "no-such-group"), "no-such-group")


def test_registry_validates_and_raises_on_unknown():
    with pytest.raises(ValueError):
        registry.register_pipeline(registry.PipelineSpec("broken", registry.ModelProject.LLM, data=None))
    with pytest.raises(KeyError):
        registry.get_pipeline("unknown")
    assert registry.model_project("text_classifier") is registry.ModelProject.LLM


def test_checkpoint_dir_is_shared_setting(spark):
    from tessera.session import checkpoint_dir

    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d


def test_halo_neighbours_equal_plain_lag_lead(spark):
    long = T.to_long(v_traj(spark, SF_SMALL))
    got = T.neighbours(long, back=2, forward=1, bucket_width=4)
    w = Window.partitionBy(*T.KEYS, "d").orderBy("frame")
    want = long.select(
        *T.KEYS, "frame", "d", F.lag("x", 1).over(w).alias("p1"), F.lag("x", 2).over(w).alias("p2"),
        F.lead("x", 1).over(w).alias("n1"),
    )
    j = got.join(want, T.KEYS + ["frame", "d"])
    assert j.count() == long.count()
    bad = j.where(
        ~F.col("prev_1").eqNullSafe(F.col("p1")) | ~F.col("prev_2").eqNullSafe(F.col("p2")) | ~F.col("next_1").eqNullSafe(F.col("n1"))
    )
    assert bad.count() == 0


def test_flagship_independent_of_partitioning(spark):
    from tessera.plans.text_eval import evaluate_text

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        a = sorted(evaluate_text(spark, SF_CHECK).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        b = sorted(evaluate_text(spark, SF_CHECK).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b
