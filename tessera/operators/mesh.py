"""Mesh / node-table statistics and losses (AG9, AG13, AG15-AG17, AG21, FP9,
FP10, FP15, SM1, SM2, SM7).

Nodes carry fixed-width vectors (``velocity``, ``onehot``, ``y``, ``pred``);
every statistic is a grouped aggregate with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import normalize, sq_error, vadd, vscale
from tessera.operators.core import hash_rank

EPS = 1e-8
NORMAL, OUTFLOW = 0, 5


def feature_stats(df: DataFrame, vec: str, *, eps: float = EPS) -> DataFrame:
    """AG9: per component ``i`` of ``vec``: mean and population std
    ``max(sqrt(E[x^2] - E[x]^2), eps)`` (NaN stays NaN, like the reference)."""
    long = df.select(F.posexplode(vec).alias("i", "v"))
    m = F.avg("v")
    return long.groupBy("i").agg(
        m.alias("mean"),
        F.greatest(F.sqrt(F.avg(F.col("v") * F.col("v")) - m * m), F.lit(eps)).alias("std"),
    ).withColumn("i", F.col("i").cast("int"))


def stats_literals(stats: DataFrame) -> tuple[Column, Column]:
    """The per-component statistics as literal array columns. The table has
    one row per vector component (bounded by the feature width), so it is
    collected once and inlined instead of being joined to every row."""
    rows = stats.orderBy("i").collect()
    mean = F.array(*[F.lit(float(r["mean"])) for r in rows])
    std = F.array(*[F.lit(float(r["std"])) for r in rows])
    return mean, std


def loss_mask(node_type: Column) -> Column:
    """FP9: nodes of type normal (0) or outflow (5)."""
    return node_type.isin(NORMAL, OUTFLOW)


def masked_rmse_per_batch(nodes: DataFrame, y_stats: DataFrame, *, batch: str = "batch", y: str = "y",
                          pred: str = "pred", node_type: str = "node_type") -> DataFrame:
    """AG15: per batch ``sqrt(mean over masked nodes of sum((norm(y) - pred)^2))``;
    a batch with no masked node gives NULL (the reference gives NaN, Q14)."""
    mean, std = stats_literals(y_stats)
    err = sq_error(normalize(F.col(y), mean, std), F.col(pred))
    return nodes.groupBy(batch).agg(F.sqrt(F.avg(F.when(loss_mask(F.col(node_type)), err))).alias("loss"))


def velocity_rmse_per_batch(nodes: DataFrame, *, dt: float = 0.01, batch: str = "batch", velocity: str = "velocity",
                            y: str = "y", pred: str = "pred", node_type: str = "node_type") -> DataFrame:
    """AG16 + SM7: ``sqrt(mean over masked nodes of |(v + pred dt) - (v + y dt)|^2)``
    per batch; ``pred`` is used as given (the reference's Q11)."""
    ev = vadd(F.col(velocity), vscale(F.col(pred), dt))
    gs = vadd(F.col(velocity), vscale(F.col(y), dt))
    err = sq_error(ev, gs)
    return nodes.groupBy(batch).agg(F.sqrt(F.avg(F.when(loss_mask(F.col(node_type)), err))).alias("velo_rmse"))


def one_step_mse_per_batch(nodes: DataFrame, scale: list[float], *, batch: str = "batch", y: str = "y",
                           pred: str = "pred") -> DataFrame:
    """AG13: per batch ``loss = mean((p - y)^2)`` over nodes x dims and
    ``mse = mean over nodes of sum over dims ((p - y) * scale)^2``."""
    k = len(scale)
    diff = F.zip_with(F.col(pred), F.col(y), lambda a, b: a - b)
    scaled = F.zip_with(diff, F.array(*[F.lit(s) for s in scale]), lambda d, s: d * s)
    return nodes.groupBy(batch).agg(
        (F.avg(F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x * x)) / F.lit(float(k))).alias("loss"),
        F.avg(F.aggregate(scaled, F.lit(0.0), lambda acc, x: acc + x * x)).alias("mse"),
    )


def mean_over_batches(per_batch: DataFrame, cols: list[str]) -> DataFrame:
    """Unweighted mean of per-batch values (AG13, AG15, AG16)."""
    return per_batch.agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).cast("bigint").alias("num_batches"))


def mse(nodes: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """AG17: mean over all elements of ``(pred - y)^2``."""
    e = F.aggregate(F.zip_with(F.col(pred), F.col(y), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    return nodes.agg((F.sum(e) / F.sum(F.size(y))).alias("mse"))


def residual_fields(nodes: DataFrame, *, dt: float = 0.01, velocity: str = "velocity", y: str = "y",
                    pred: str = "pred") -> DataFrame:
    """FP15 + SM7: next velocity from prediction and from truth, and their
    difference, all computed from the untouched input (Q13)."""
    ev = vadd(F.col(velocity), vscale(F.col(pred), dt))
    gs = vadd(F.col(velocity), vscale(F.col(y), dt))
    return nodes.withColumn("eval_velo", ev).withColumn("gs_velo", gs).withColumn(
        "err_velo", F.zip_with(F.col("eval_velo"), F.col("gs_velo"), lambda a, b: a - b)
    )


def value_bounds(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """AG21: min / max over all components of each field."""
    long = nodes.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in fields])).alias("s"))
    long = long.select("s.field", F.explode("s.v").alias("x"))
    return long.groupBy("field").agg(F.min("x").alias("vmin"), F.max("x").alias("vmax"))


def train_test_samples(nodes: DataFrame, *, test_size: int, sample: str = "sample", seed: int = 0) -> DataFrame:
    """FP10: every sample gets a split: the first ``test_size`` of the seeded
    shuffle are test, all others train."""
    ranked = hash_rank(nodes.select(sample).distinct(), sample, seed, rank_col="__r")
    return ranked.select(sample, F.when(F.col("__r") <= test_size, "test").otherwise("train").alias("split"))
