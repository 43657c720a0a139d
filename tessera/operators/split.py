"""Exact stratified splits and the split column helpers (WN10, FP4, SO1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tessera.operators.core import bucketed_rank, hash_rank, range_bucket, range_splitters


def stratified_split(
    df: DataFrame,
    *,
    key: str,
    stratify: str = "tag",
    test_size: float | int = 0.2,
    shuffle: bool = True,
    seed: int = 1234,
    digits: int = 3,
    split_col: str = "_split",
) -> DataFrame:
    """WN10: per ``stratify`` group of size n, ``n_test = ceil(test_size * n)``
    rows go to ``test`` (an integer ``test_size`` is an absolute count); the
    rest to ``train``. With ``shuffle`` the test rows are the first of the
    seeded order ``md5(key ':' seed)``; without it they are the last rows by
    ``key``. A group whose train side would be empty raises at execution.

    Counts per class, disjointness and completeness are exact (not
    ``sampleBy``); the ranking never puts a whole class in one task.
    """
    if shuffle:
        ranked = hash_rank(df, key, seed, group_cols=[stratify], digits=digits, rank_col="__r", size_col="__n")
    elif isinstance(df.schema[key].dataType, T.NumericType):
        # last rows by key: rank by key descending, bucketed by key range
        bucket = -F.floor(F.col(key).cast("double") / F.lit(float(1 << 16))).cast("bigint")
        bucket = F.coalesce(bucket, F.lit(2**62))  # a NULL key comes last in descending order
        ranked = bucketed_rank(df, order=[F.col(key).desc()], bucket=bucket, group_cols=[stratify],
                               rank_col="__r", size_col="__n")
    else:  # text, timestamps, ...: ranges of a sample of the keys
        bucket = -range_bucket(df, [key], range_splitters(df, [key]))
        ranked = bucketed_rank(df, order=[F.col(key).desc()], bucket=bucket, group_cols=[stratify],
                               rank_col="__r", size_col="__n")
    if isinstance(test_size, int) and not isinstance(test_size, bool) and test_size >= 1:
        n_test = F.lit(int(test_size)).cast("bigint")
    else:
        n_test = F.ceil(F.lit(float(test_size)) * F.col("__n").cast("double")).cast("bigint")
    guarded = F.when(
        F.col("__n") - n_test <= 0,
        F.raise_error(F.lit(f"stratified_split: empty train side for a {stratify} group")),
    ).otherwise(n_test)
    return ranked.withColumn(
        split_col, F.when(F.col("__r") <= guarded, F.lit("test")).otherwise(F.lit("train"))
    ).drop("__r", "__n")


def filter_split(df: DataFrame, split: str, split_col: str = "_split") -> DataFrame:
    """FP4: rows of one split, helper column dropped."""
    return df.filter(F.col(split_col) == F.lit(split)).drop(split_col)


def concat_splits(train: DataFrame, test: DataFrame, split_col: str = "_split") -> DataFrame:
    """SO1: train + test with a split column."""
    return train.withColumn(split_col, F.lit("train")).unionByName(
        test.withColumn(split_col, F.lit("test"))
    )
