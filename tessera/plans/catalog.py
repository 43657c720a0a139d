"""Registry of checked queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that its registrations run."""
    from tessera.plans import (  # noqa: F401
        graph_queries,
        model_queries,
        source_queries,
        stream_queries,
        quality_queries,
        runs_queries,
        text_queries,
        traj_queries,
    )
