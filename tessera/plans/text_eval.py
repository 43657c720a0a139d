"""Evaluate a text classifier on the labelled-text table (the flagship job).

documents -> V_text -> text feature + cleaning -> exact stratified split ->
test rows joined to predictions on the key -> overall / per-class / slice
metrics. Only the final metric table (a few dozen rows) is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import LLM_TERMS, clean_text, slice_nlp_llm, slice_short_text, text_feature
from tessera.operators.metrics import metric_cube
from tessera.operators.split import filter_split, stratified_split
from tessera.operators.text import fit_class_index
from tessera.plans.views import SLICE_TAG, v_text

TEST_SIZE = 0.2
SEED = 1234


def default_slices(tag="tag", text="text") -> dict:
    return {
        "nlp_llm": slice_nlp_llm(F.col(tag), F.col(text), SLICE_TAG, LLM_TERMS),
        "short_text": slice_short_text(F.col(text)),
    }


def scored_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Test split truth joined with predictions on ``id`` (JN7)."""
    vt = v_text(spark, sf)
    split = stratified_split(vt, key="id", stratify="tag", test_size=TEST_SIZE, seed=SEED)
    truth = filter_split(split, "test").select(
        "id", "tag", text_feature(F.col("title"), F.col("description")).alias("text")
    )
    preds = vt.select("id", "y_pred")
    return truth.join(preds, on="id", how="inner").withColumnRenamed("tag", "y_true").withColumn(
        "tag", F.col("y_true")
    )


def evaluation_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The metric cube of the test split."""
    return metric_cube(scored_test_rows(spark, sf), fit_class_index(v_text(spark, sf)), default_slices())


def evaluate_text(spark: SparkSession, sf: str) -> DataFrame:
    """All three scopes from one scan of the scored rows."""
    rows = evaluation_rows(spark, sf)
    return rows.select(
        "scope",
        "key",
        F.round("precision", 9).alias("precision"),
        F.round("recall", 9).alias("recall"),
        F.round("f1", 9).alias("f1"),
        F.col("num_samples").cast("double").alias("num_samples"),
    )


def cleaned_text(spark: SparkSession, sf: str) -> DataFrame:
    vt = v_text(spark, sf, spread=True)
    return vt.select("id", clean_text(text_feature(F.col("title"), F.col("description"))).alias("text"))
