"""Rows with NULL keys and NULL values stay in ranks, running sums, splits,
retention and best checkpoints."""

from pyspark.sql import functions as F

from tessera.operators.core import hash_rank
from tessera.operators.runs import best_checkpoint, retention, retention_rank, running_avg
from tessera.operators.split import stratified_split


def test_ranks_of_null_groups_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (None, "a"), (None, None)], "id long, g string")
    rows = hash_rank(df, "id", 7, group_cols=["g"], size_col="n").collect()
    ranks = {}
    for r in rows:
        ranks.setdefault(r.g, []).append((r["rank"], r.n))
    assert {k: sorted(v) for k, v in ranks.items()} == {"a": [(1, 2), (2, 2)], None: [(1, 3), (2, 3), (3, 3)]}


def test_split_keeps_null_labels(spark):
    df = spark.range(10).withColumn("tag", F.when(F.col("id") % 2 == 0, "x"))
    for shuffle in (True, False):
        counts = {(r.tag, r._split): r["count"]
                  for r in stratified_split(df, key="id", test_size=0.2, shuffle=shuffle).groupBy("tag", "_split").count().collect()}
        assert counts == {("x", "test"): 1, ("x", "train"): 4, (None, "test"): 1, (None, "train"): 4}


def test_running_average_keeps_null_epochs_and_steps(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 1.0), (1, None, 0, 2.0), (1, None, 1, 4.0), (1, 0, None, 5.0)],
        "run_id long, epoch long, step long, loss double",
    )
    got = {(r.epoch, r.step): r.avg_loss for r in running_avg(df).collect()}
    assert got == {(0, None): 5.0, (0, 0): 3.0, (None, 0): 2.0, (None, 1): 3.0}


def test_retention_keeps_one_per_group(spark):
    rows = [("r", None, 5, "a"), ("r", None, 5, "b"), ("r", None, 4, "c"), ("r", "m", 5, "d"), (None, "m", None, "e")]
    rows += [("r", "q", 1, "same")] * 50
    df = spark.createDataFrame(rows, "run_id string, type string, created_at long, name string")
    df = df.withColumn("created_at", F.timestamp_seconds("created_at"))
    out = retention(df)
    assert out.count() == len(rows)
    kept = {(r.run_id, r.type): r["count"] for r in out.where("action = 'keep'").groupBy("run_id", "type").count().collect()}
    assert kept == {("r", None): 1, ("r", "m"): 1, (None, "m"): 1, ("r", "q"): 1}
    ranks = {r.name: r["rank"] for r in retention_rank(df.where("type IS NULL"), tiebreak=["name"]).collect()}
    assert ranks == {"b": 1, "a": 2, "c": 3}


def test_null_losses_never_win(spark):
    df = spark.createDataFrame(
        [("a", 0, None), ("a", 1, 3.0), ("b", 0, 2.0), ("b", 1, None), ("c", 0, None)], "run_id string, step long, loss double"
    )
    got = {r.run_id: (r.best_loss, r.best_step, r.is_best) for r in best_checkpoint(df).collect()}
    assert got == {"a": (3.0, 1, False), "b": (2.0, 0, True), "c": (None, None, False)}
