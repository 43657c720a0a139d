"""The training-data pipeline: five operators, each on what the one before kept.

Each stage is written as Parquet under the shared checkpoint folder and read
again by the next one, so a lost executor costs at most a stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import classifier, mixing, packing, quality, simhash
from tessera.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.keep_good(docs, classifier.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_docs(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]
#: The classifier, the linking of near copies and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents that the stages keep, with their places in sequences.

    * Null and empty texts go in the first stage; null ids, sources and languages pass all stages.
    * Repeated rows count as near copies: one of them stays, until the mix repeats it.
    * Further columns of ``documents`` pass all stages but the last; names that begin
      with two underscores are taken. An empty table gives no rows.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
