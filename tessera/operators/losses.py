"""Loss and error aggregates: BCE with logits, MSE, running means of batch
losses, squared-error reductions (AG13-AG19, SM9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import one_hot


def bce_with_logits_sum(z, target_index, k: int) -> Column:
    """Per row: sum over k classes of ``max(z,0) - z*t + ln(1 + exp(-|z|))``
    with one-hot targets (numerically stable form)."""
    zc = F.col(z) if isinstance(z, str) else z
    t = one_hot(F.col(target_index) if isinstance(target_index, str) else target_index, k)
    terms = F.zip_with(
        zc, t, lambda zi, ti: F.greatest(zi, F.lit(0.0)) - zi * ti + F.log(F.lit(1.0) + F.exp(-F.abs(zi)))
    )
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def batch_means(df: DataFrame, batch: str, total: Column, count: Column, out: str = "loss") -> DataFrame:
    """Per-batch mean ``sum(total) / sum(count)``."""
    return df.groupBy(batch).agg((F.sum(total) / F.sum(count)).alias(out))


def running_mean_of_batches(per_batch: DataFrame, loss: str = "loss", out: str = "avg_loss") -> DataFrame:
    """AG19: ``loss += (J - loss) / (i + 1)`` over batches is the plain mean of
    the batch means (a short last batch weighs like the others)."""
    return per_batch.agg(F.avg(loss).alias(out), F.count(F.lit(1)).cast("bigint").alias("num_batches"))
