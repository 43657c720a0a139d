"""MLlib jobs re-aimed from the reference's trainer / predictor (ML1-ML6, UD4).

* ML1 ``fit_text_classifier``: Pipeline(StringIndexer, RegexTokenizer,
  HashingTF, IDF, LogisticRegression) on cleaned text; the optimizer's
  per-iteration loss becomes a history table.
* ML2 ``predict_tags``: probabilities -> thresholded argmax with a fallback
  class -> label decode (broadcast join on the k-row label table).
* ML3 ``evaluate_text_model``: predict + the metric operators.
* ML4 ``tune_text_classifier``: random search over a hash-drawn trial table,
  ``TrainValidationSplit(parallelism=2)``.
* ML5 ``behavioral_checks``: invariance / minimum-functionality cases scored
  in one ``transform`` and joined back by case id.
* ML6 ``score_batches``: a user scoring function over Arrow batches
  (``mapInPandas``).
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import thresholded_argmax
from tessera.functions.hashing import hash_uniform
from tessera.operators.core import LOOKUP_ROWS
from tessera.operators.text import encode_labels, fit_class_index


def text_classifier_pipeline(*, label: str = "tag", text: str = "text", num_features: int = 1 << 16,
                             max_iter: int = 20, reg_param: float = 0.0, elastic_net: float = 0.0) -> Pipeline:
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg_param,
                            elasticNetParam=elastic_net, family="multinomial")
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"),
            RegexTokenizer(inputCol=text, outputCol="tokens", pattern=" ", gaps=True, minTokenLength=1),
            HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
            IDF(inputCol="tf", outputCol="features"),
            lr,
        ]
    )


def fit_text_classifier(train: DataFrame, **kw) -> tuple[PipelineModel, DataFrame]:
    """ML1: fit; returns the model and ``(iteration, loss)`` (objective history)."""
    model = text_classifier_pipeline(**kw).fit(train)
    hist = model.stages[-1].summary.objectiveHistory  # maxIter floats
    spark = train.sparkSession
    history = spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")
    return model, history


def class_labels(model) -> list[str]:
    """Labels in index order, of a pipeline or of a :class:`tessera.operators.bayes.NaiveBayes`."""
    return list(model.labels if hasattr(model, "labels") else model.stages[0].labels)


def _probabilities(model, df: DataFrame, key: str, text: str) -> DataFrame:
    if hasattr(model, "probabilities"):
        return model.probabilities(df, key, text)
    return model.transform(df).select(key, F.col(text).alias("input_text"), vector_to_array("probability").alias("probability"))


def predict_tags(model, df: DataFrame, *, threshold: float, fallback: str, key: str = "id",
                 text: str = "text") -> DataFrame:
    """ML2 + AR2 + JN2: ``(key, input_text, pred_index, predicted_tags)``;
    argmax when the top probability exceeds ``threshold``, else the index of
    ``fallback``."""
    labels = class_labels(model)
    if fallback not in labels:
        raise KeyError(fallback)
    spark = df.sparkSession
    scored = _probabilities(model, df, key, text).select(
        key, "input_text", thresholded_argmax(F.col("probability"), threshold, labels.index(fallback)).alias("pred_index")
    )
    lut = spark.createDataFrame(list(enumerate(labels)), "pred_index long, predicted_tags string")
    small = len(labels) <= LOOKUP_ROWS
    return scored.join(F.broadcast(lut) if small else lut, on="pred_index", how="left")


def evaluate_text_model(model, test: DataFrame, slices: dict, *, key: str = "id",
                        threshold: float = 0.0, fallback: str | None = None) -> DataFrame:
    """ML3: predictions joined to truth by key, then AG8 metric rows."""
    from tessera.operators.metrics import metric_rows

    labels = class_labels(model)
    preds = predict_tags(model, test, threshold=threshold, fallback=fallback or labels[0], key=key)
    keep = [c for c in test.columns if c not in (key, "tag", "y_true", "y_pred")]
    scored = test.select(key, F.col("tag").alias("y_true"), "tag", *keep)
    scored = scored.join(preds.select(key, F.col("predicted_tags").alias("y_pred")), on=key)
    classes = fit_class_index(test)
    return metric_rows(scored, classes, slices)


def trial_params(trials: DataFrame, seed: int = 1234, id_col: str = "trial_id") -> DataFrame:
    """SM10: ``trials`` with the search space drawn from md5 uniforms of the
    trial id: dropout U(0.3, 0.9), lr log-U(1e-5, 5e-4), lr_factor U(0.1, 0.9),
    lr_patience U(1, 10). A trial draws the same in every run and order."""
    u = lambda name: hash_uniform([id_col], f"{seed}:{name}")
    a, b = math.log(1e-5), math.log(5e-4)
    return trials.select(
        id_col,
        (F.lit(0.3) + F.lit(0.6) * u("dropout_p")).alias("dropout_p"),
        F.exp(F.lit(a) + F.lit(b - a) * u("lr")).alias("lr"),
        (F.lit(0.1) + F.lit(0.8) * u("lr_factor")).alias("lr_factor"),
        (F.lit(1.0) + F.lit(9.0) * u("lr_patience")).alias("lr_patience"),
    )


def trial_table(spark: SparkSession, num_runs: int, seed: int = 1234) -> DataFrame:
    """SM10: the parameters of ``num_runs`` trials, numbered from 0."""
    return trial_params(spark.range(num_runs).withColumnRenamed("id", "trial_id"), seed)


def tune_text_classifier(train: DataFrame, trials: DataFrame, *, parallelism: int = 2, seed: int = 1234) -> DataFrame:
    """ML4: one MLlib candidate per trial row (regParam <- lr,
    elasticNetParam <- lr_factor, maxIter <- 5 + round(lr_patience));
    returns ``(trial_id, ..., val_loss, is_best)``, the best being the one of
    the lowest validation loss (log loss; ties: first trial). ``dropout_p`` has
    no counterpart in this model and is only reported. The trial table is a
    parameter list of ``num_runs`` rows, collected to build the param maps."""
    pipe = text_classifier_pipeline()
    lr = pipe.getStages()[-1]
    rows = trials.orderBy("trial_id").collect()
    maps = [
        {lr.regParam: float(r["lr"]), lr.elasticNetParam: float(r["lr_factor"]), lr.maxIter: 5 + int(round(r["lr_patience"]))}
        for r in rows
    ]
    tvs = TrainValidationSplit(
        estimator=pipe, estimatorParamMaps=maps, trainRatio=0.8, parallelism=parallelism, seed=seed,
        evaluator=MulticlassClassificationEvaluator(metricName="logLoss", labelCol="label", predictionCol="prediction"),
    )
    fitted = tvs.fit(train)
    spark = train.sparkSession
    best = min(range(len(rows)), key=lambda i: fitted.validationMetrics[i])
    out = [
        (int(r["trial_id"]), float(r["dropout_p"]), float(r["lr"]), float(r["lr_factor"]), float(r["lr_patience"]),
         float(fitted.validationMetrics[i]), i == best)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(
        out, "trial_id long, dropout_p double, lr double, lr_factor double, lr_patience double, val_loss double, is_best boolean"
    )


def behavioral_checks(model, cases: DataFrame, *, threshold: float = 0.0, fallback: str | None = None) -> DataFrame:
    """ML5 + JN10: cases ``(case_id, kind, input_a, input_b, expected)``;
    kinds ``invariance`` (a and b must get the same tag), ``directional`` and
    ``mft`` (a must get ``expected``). All inputs are scored in one pass."""
    labels = class_labels(model)
    fb = fallback or labels[0]
    inputs = cases.select("case_id", F.lit("a").alias("side"), F.col("input_a").alias("text")).unionByName(
        cases.where(F.col("input_b").isNotNull()).select("case_id", F.lit("b").alias("side"), F.col("input_b").alias("text"))
    ).withColumn("tag", F.lit(labels[0]))
    inputs = inputs.withColumn("__k", F.concat_ws(":", F.col("case_id").cast("string"), "side"))
    preds = predict_tags(model, inputs, threshold=threshold, fallback=fb, key="__k")
    p = preds.select(
        F.split("__k", ":")[0].cast("long").alias("case_id"), F.split("__k", ":")[1].alias("side"), "predicted_tags"
    )
    a = p.where(F.col("side") == "a").select("case_id", F.col("predicted_tags").alias("pred_a"))
    b = p.where(F.col("side") == "b").select("case_id", F.col("predicted_tags").alias("pred_b"))
    j = cases.join(a, "case_id", "left").join(b, "case_id", "left")
    passed = F.when(F.col("kind") == "invariance", F.col("pred_a") == F.col("pred_b")).otherwise(F.col("pred_a") == F.col("expected"))
    return j.withColumn("passed", F.coalesce(passed, F.lit(False)))


def score_batches(df: DataFrame, score_fn, schema: str) -> DataFrame:
    """ML6 / UD1: apply ``score_fn(pandas.DataFrame) -> pandas.DataFrame`` to
    Arrow batches of every partition (no gradient, no shuffle)."""

    from tessera.session import ship_package

    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            yield score_fn(pdf)

    return df.mapInPandas(run, schema)


class ClassIndexer(Estimator):
    """UD4: an Estimator whose fitted state is the class index (AG3)."""

    def __init__(self, label: str = "tag", index_col: str = "class_index"):
        super().__init__()
        self.label, self.index_col = label, index_col

    def _fit(self, dataset: DataFrame) -> "ClassIndexModel":
        classes = fit_class_index(dataset, self.label, self.index_col)
        rows = classes.orderBy(self.index_col).collect()  # k labels
        return ClassIndexModel([r[self.label] for r in rows], self.label, self.index_col)


class ClassIndexModel(Model):
    def __init__(self, labels: list[str], label: str = "tag", index_col: str = "class_index"):
        super().__init__()
        self.labels, self.label, self.index_col = labels, label, index_col

    @property
    def class_to_index(self) -> dict[str, int]:
        return {c: i for i, c in enumerate(self.labels)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        lut = spark.createDataFrame(list(enumerate(self.labels)), f"{self.index_col} long, {self.label} string")
        return encode_labels(dataset, lut, self.label, self.index_col)
