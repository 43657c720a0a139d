"""Hub nodes: heavy hitters, the salted join, and the spread of its tasks."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.skew import heavy_hitters, salts_of, spread_join


@pytest.fixture()
def plain_shuffles(spark):
    """Every join a shuffle join of 24 partitions, as Spark plans it before it looks at sizes."""
    conf = {
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def edges_with_hub(spark, n=60_000, nodes=6_000):
    """A third of all edges point to node 0, a twentieth of them come from node 1."""
    i = F.col("id")
    dst = F.when(i % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(i), F.lit(nodes)))
    src = F.when(i % 20 == 1, 1).otherwise(F.pmod(F.xxhash64(i, F.lit(7)), F.lit(nodes)))
    return spark.range(n).select(src.alias("src"), dst.alias("dst"), F.array(i.cast("double")).alias("attr"))


def per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_no_task_of_a_hub_join_is_long(spark, plain_shuffles):
    edges, nodes = edges_with_hub(spark), spark.range(6_000).select(F.col("id").alias("dst"), (F.col("id") * 2).alias("x"))
    salts = salts_of(edges, "dst")
    hot, cold = per_task(spread_join(edges, nodes, "dst", salts)), per_task(edges.join(nodes, "dst"))
    assert cold[-1] > 5 * statistics.median(cold)  # without salts
    assert hot[-1] <= 3 * statistics.median(hot) and sum(hot) == sum(cold)


def test_spread_join_equals_join(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 0, 0, 0, 1, rng.randint(2, 40)]), k) for k in range(2000)] + [(0, -1)] * 50
    large = spark.createDataFrame(rows, "k long, v long")
    small = spark.createDataFrame([(k, f"n{k}") for k in range(30)] + [(0, "again"), (None, "null")], "k long, name string")
    salts = salts_of(large, "k", share=0.05)
    assert {r["__salts"] > 1 for r in salts.collect()} == {True}
    for how in ("inner", "left"):
        want = large.join(small, on="k", how=how)
        got = spread_join(large, small, "k", salts, how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        spread_join(large, small, "k", salts, "outer")


def test_message_pass_with_hubs_is_the_same(spark):
    edges = edges_with_hub(spark, 9_000, 500)
    nodes = spark.range(501).select(F.col("id").alias("node"), F.array((F.col("id") % 7).cast("double")).alias("x"))
    message = lambda a, b, e: F.array(a[0] * 3 - b[0])
    hubs = G.find_hubs(edges, share=0.02)
    assert hubs[0] is not None and hubs[1] is not None
    got = G.message_pass_rounds(nodes, edges, message, rounds=2, width=1, hubs=hubs)
    want = G.message_pass_rounds(nodes, edges, message, rounds=2, width=1)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_heavy_hitters_are_exact(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]) if rng.random() < 0.5 else str(rng.random()), 1) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, g int").repartition(5)
    got = {r["k"]: r["n"] for r in heavy_hitters(df, ["k"], 0.1).collect()}
    keys = [k for k, _ in rows]
    assert got == {k: keys.count(k) for k in ("a", "b", None)}
    assert heavy_hitters(df.where("false"), "k", 0.1).collect() == []
    assert salts_of(df.where("false"), "k") is None
