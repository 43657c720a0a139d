"""Escape hatches for per-batch / per-group Python (UD1, UD2, UD3).

Prefer column expressions; these wrap the Arrow-batched pandas paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from tessera.session import ship_package


def map_batches(df: DataFrame, fn: Callable, schema: str, **fn_kwargs) -> DataFrame:
    """UD1: ``fn(pandas.DataFrame, **fn_kwargs) -> pandas.DataFrame`` per Arrow batch."""
    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            yield fn(pdf, **fn_kwargs)

    return df.mapInPandas(run, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """UD2: ``fn(pandas.DataFrame) -> pandas.DataFrame`` per key group. A whole
    group is materialized in one Python worker, so use it only for groups of
    bounded size; stratified splitting (the reference's use) is done with
    ``stratified_split`` instead."""
    ship_package(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def slicing_functions(**predicates: Column) -> dict[str, Column]:
    """UD3: named row predicates (``name=Column``) for ``slice_flags`` /
    ``slice_metrics``."""
    return dict(predicates)
