"""Pipeline component registry (UD6, UD7, UD8).

A model id maps to its project and its component functions; a registration
missing a required component is rejected up front (the reference would only
fail when the missing component is called, Q10).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class ModelProject(str, Enum):
    LLM = "LLM"
    GNS = "GNS"


class DatasetSource(Protocol):
    """UD6: load, split and describe a dataset (:mod:`tessera.plans.handlers`)."""

    def load(self, spark: SparkSession, path: str) -> DataFrame: ...

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]: ...

    def size(self, df: DataFrame) -> int: ...

    def get(self, df: DataFrame, item) -> DataFrame: ...


class MetricSet(Protocol):
    """UD7: scored rows -> metric rows."""

    def __call__(self, scored: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class PipelineSpec:
    model_id: str
    project: ModelProject
    data: DatasetSource | None = None
    preprocess: Callable | None = None
    metrics: MetricSet | None = None
    model: Callable | None = None
    required: tuple[str, ...] = field(default=("data", "metrics"))


_REGISTRY: dict[str, PipelineSpec] = {}


def register_pipeline(spec: PipelineSpec) -> PipelineSpec:
    missing = [r for r in spec.required if getattr(spec, r) is None]
    if missing:
        raise ValueError(f"{spec.model_id}: missing components {missing}")
    _REGISTRY[spec.model_id] = spec
    return spec


def get_pipeline(model_id: str) -> PipelineSpec:
    """Unknown ids raise ``KeyError`` like the reference's lookups."""
    return _REGISTRY[model_id]


def model_project(model_id: str) -> ModelProject:
    return get_pipeline(model_id).project


def registered() -> list[str]:
    return sorted(_REGISTRY)


def _builtin() -> None:
    from tessera.operators import mesh as ME
    from tessera.operators import trajectory as T
    from tessera.operators.bayes import fit_naive_bayes
    from tessera.operators.text import preprocess
    from tessera.plans import handlers as H

    register_pipeline(PipelineSpec("text_classifier", ModelProject.LLM, data=H.TextData(), preprocess=preprocess,
                                   metrics=H.TextMetrics(), model=fit_naive_bayes))
    register_pipeline(PipelineSpec("trajectory_gns", ModelProject.GNS, data=H.TrajectoryData(),
                                   preprocess=T.materialize_windows, metrics=H.TrajectoryMetrics()))
    register_pipeline(PipelineSpec("mesh_graph", ModelProject.GNS, data=H.MeshData(), preprocess=ME.feature_stats,
                                   metrics=H.MeshMetrics()))


_builtin()
