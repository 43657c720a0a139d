"""Data and metric handlers of the registered pipelines (UD6, UD7)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import mesh as ME
from tessera.operators import trajectory as TR
from tessera.operators.metrics import metric_cube
from tessera.operators.split import filter_split, stratified_split
from tessera.operators.text import fit_class_index
from tessera.sources import files, tensor_store


class TableData:
    """UD6: a dataset as a table with a key; subclasses say how it is read and split."""

    key = "id"

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        raise NotImplementedError

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        raise NotImplementedError

    def size(self, df: DataFrame) -> int:
        """How many items the dataset has: different keys."""
        return df.select(self.key).distinct().count()

    def get(self, df: DataFrame, item) -> DataFrame:
        """The rows of one item; none if there is no such key."""
        return df.where(F.col(self.key).eqNullSafe(F.lit(item)))


@dataclass
class TextData(TableData):
    """Labelled texts in CSV, split exactly within each label."""

    test_size: float = 0.2
    seed: int = 1234

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        return files.read_csv(spark, path)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        dealt = stratified_split(df, key=self.key, test_size=self.test_size, seed=self.seed)
        return filter_split(dealt, "train"), filter_split(dealt, "test")


@dataclass
class _SampleData(TableData):
    """Rows of samples: the first ``test_size`` samples of a seeded shuffle are the test side, whole."""

    test_size: int = 1
    seed: int = 0

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        dealt = df.join(ME.train_test_samples(df, test_size=self.test_size, sample=self.key, seed=self.seed), self.key)
        return tuple(dealt.where(F.col("split") == s).drop("split") for s in ("train", "test"))


class TrajectoryData(_SampleData):
    """Trajectories of a committed tensor store."""

    key = "traj_id"

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        return tensor_store.read_store(spark, path)


class MeshData(_SampleData):
    """Mesh nodes in parquet."""

    key = "sample"

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)


@dataclass
class TextMetrics:
    """UD7: ``y_true`` and ``y_pred`` to overall, per-class and per-slice rows."""

    slices: dict[str, Column] = field(default_factory=dict)
    classes: DataFrame | None = None

    def __call__(self, scored: DataFrame) -> DataFrame:
        classes = self.classes or fit_class_index(scored.withColumnRenamed("y_true", "__l"), "__l").withColumnRenamed("__l", "tag")
        return metric_cube(scored, classes, self.slices)


class TrajectoryMetrics:
    """UD7: long rows with true ``x`` and predicted ``xp`` to the mean rollout error."""

    def __call__(self, scored: DataFrame) -> DataFrame:
        keys = [*TR.KEYS, "frame", "d"]
        pred, truth = scored.select(*keys, F.col("xp").alias("x")), scored.select(*keys, "x")
        return TR.mean_rollout_mse(TR.rollout_mse(pred, truth))


@dataclass
class MeshMetrics:
    """UD7: nodes with ``y`` and ``pred`` to the masked error, averaged over batches."""

    dt: float = 0.01

    def __call__(self, scored: DataFrame) -> DataFrame:
        loss = ME.masked_rmse_per_batch(scored, ME.feature_stats(scored, "y"))
        return ME.mean_over_batches(loss.join(ME.velocity_rmse_per_batch(scored, dt=self.dt), "batch"), ["loss", "velo_rmse"])
