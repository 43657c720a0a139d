"""Helpers shared by the operators: sessions, folds, materialized frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, materialize, ship_package
from tessera.sources.tables import table

__all__ = ["fold_of", "materialize", "prepare", "table", "threshold_sample"]

#: Documents handed to a Python worker at once: bounds its memory on long texts.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder, the package on the workers, small Arrow batches."""
    checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold_of(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; fold 0 is held out. Null ids: null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def threshold_sample(df: DataFrame, key: Column, at_most: int, total: int) -> DataFrame:
    """About ``at_most`` of ``total`` rows, chosen by the hash of ``key``.

    The choice is a filter on the scan, so it costs no shuffle and is the same
    in every run. Everything is kept where ``total`` is not above ``at_most``.
    """
    if total <= at_most:
        return df
    steps = 1 << 30
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps)) < int(steps * at_most / total))
