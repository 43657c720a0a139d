"""Selections without a sort, range buckets of any type, and the unshuffled split on them."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_hex
from tessera.operators import core
from tessera.operators.split import stratified_split


def test_half_of_a_table_is_taken_in_many_tasks(spark):
    df = spark.range(0, 40_000, 1, 16).withColumn("v", F.col("id") * 2)
    half = core.take_sample(df, "id", 20_000, seed=3)
    want = {r.id for r in df.orderBy(hash_hex(["id"], 3), "id").limit(20_000).collect()}
    assert {r.id for r in half.collect()} == want and half.columns == df.columns
    tasks = [r["count"] for r in half.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 16 and max(tasks) < 2 * 20_000 / 16
    plan = half._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "TakeOrdered" not in plan


@pytest.mark.parametrize("n", [1, 2, 7, 499, 500, 501, 900, 5000, None, 0])
def test_sample_sizes_with_repeated_and_null_keys(spark, n):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 2, *range(3, 30)]), rng.randint(0, 3)) for _ in range(900)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(3)
    got = [tuple(r) for r in core.take_sample(df, "k", n).collect()]
    assert len(got) == (min(n, 900) if n else 900)
    hashes = {r.k: r.h for r in df.select("k", F.coalesce(hash_hex(["k"], 1234), F.lit("")).alias("h")).distinct().collect()}
    order = sorted(hashes, key=hashes.get)
    counts = {k: sum(r[0] == k for r in rows) for k in order}
    left = n or 900
    for k in order:  # whole keys up to the cut
        assert sum(r[0] == k for r in got) == min(counts[k], max(0, left))
        left -= counts[k]
    assert core.take_sample(df.where("false"), "k", n).collect() == []


@pytest.mark.parametrize(
    "values",
    [
        [None, "", "a", "ab", "b", "é", "中", "Z"],
        [None, *[dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * k) for k in range(20)]],
        [None, -5.5, 0.0, 1e300, float("inf"), 3.25],
    ],
    ids=["text", "time", "number"],
)
def test_range_bucket_follows_the_order(spark, values):
    rng = random.Random(5)
    rows = [(rng.choice(values), rng.choice([None, 1, 2, 3])) for _ in range(400)]
    kind = "string" if "a" in values else "timestamp" if isinstance(values[1], dt.datetime) else "double"
    df = spark.createDataFrame(rows, f"x {kind}, y int")
    for cols in (["x"], ["x", "y"], ["y", "x"]):
        cuts = core.range_splitters(df, cols, 16)
        found = [r.b for r in df.withColumn("b", core.range_bucket(df, cols, cuts)).orderBy(*cols).collect()]
        assert found == sorted(found) and len(set(found)) > 3
        ranked = core.bucketed_rank(df, order=cols, bucket=core.range_bucket(df, cols, cuts))
        assert [r["rank"] for r in ranked.orderBy("rank").collect()] == [*range(1, 401)]
        ordered = [tuple(r[c] for c in cols) for r in ranked.orderBy("rank").collect()]
        assert ordered == [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]
    empty = df.where("false")
    assert core.range_splitters(empty, ["x"]) == []


def test_unshuffled_split_on_a_text_key_with_one_class(spark):
    df = spark.range(0, 5000, 1, 8).select(F.concat(F.lit("key "), F.md5(F.col("id").cast("string"))).alias("k"), F.lit("all").alias("tag"))
    split = stratified_split(df, key="k", test_size=0.3, shuffle=False)
    keys = sorted(r.k for r in df.collect())
    assert {r.k for r in split.where("_split = 'test'").collect()} == set(keys[-math.ceil(0.3 * 5000) :])
    cuts = core.range_splitters(df, ["k"])
    sizes = [r["count"] for r in df.groupBy(core.range_bucket(df, ["k"], cuts)).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * 5000 / 64
