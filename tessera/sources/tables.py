"""Parquet table scans. Parquet carries its schema, so nothing is inferred;
column pruning and filter pushdown reach the scan through Catalyst."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view of the same name."""
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
