"""MLlib jobs over the labelled-text and mesh views (ML1-ML6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import clean_text, text_feature
from tessera.operators import models as MD
from tessera.operators.bayes import fit_naive_bayes
from tessera.operators.split import filter_split, stratified_split
from tessera.plans.catalog import register
from tessera.plans.sql_snippets import sql_clean_text
from tessera.plans.text_eval import SEED, TEST_SIZE, default_slices
from tessera.plans.text_queries import _PRF_CTES, _SPLIT_CTE, _slices_sql
from tessera.plans.views import v_mesh, v_text, with_views
from tessera.session import materialize

THRESHOLD = 0.5
FALLBACK = "en"


def _splits(spark, sf, raw: bool = False):
    """Train and test rows ``(id, tag, text)``, with ``raw`` also the test rows' ``raw_text``, cleaned and split once:
    each pass of a fit and each use of a split reads the written rows."""
    vt = v_text(spark, sf, spread=True).withColumn("raw_text", text_feature(F.col("title"), F.col("description")))
    vt = vt.select("id", "tag", clean_text(F.col("raw_text")).alias("text"), *(["raw_text"] if raw else []))
    s = stratified_split(vt, key="id", stratify="tag", test_size=TEST_SIZE, seed=SEED)
    if raw:
        s = s.withColumn("raw_text", F.when(F.col("_split") == "test", F.col("raw_text")))
    s = materialize(s)
    return filter_split(s, "train").select("id", "tag", "text"), filter_split(s, "test")


def _fit(spark, sf, **kw):
    train, test = _splits(spark, sf, kw.pop("raw", False))
    model, history = MD.fit_text_classifier(train, max_iter=kw.pop("max_iter", 15), **kw)
    return model, history, train, test


@register("text_model_fit_history")
def q_text_model_fit_history(spark, sf):
    """ML1 + SC12: fit the text classifier on the train split; the optimizer's
    loss per iteration as a history table."""
    _, history, _, _ = _fit(spark, sf)
    return history


_BAYES_SQL = f"""WITH {_SPLIT_CTE},
cleaned AS (
  SELECT id, tag, _split, {sql_clean_text("title || ' ' || description")} AS text, title || ' ' || description AS raw_text FROM split),
train_words AS (
  SELECT tag, word, count(*) AS n FROM (
    SELECT tag, unnest(string_split(text, ' ')) AS word FROM cleaned WHERE _split = 'train') WHERE word <> '' GROUP BY ALL),
classes AS (
  SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS class_index, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior,
    coalesce((SELECT sum(n) FROM train_words w WHERE w.tag = c.tag), 0) + (SELECT count(DISTINCT word) FROM train_words) AS size
  FROM cleaned c WHERE _split = 'train' GROUP BY tag),
test_words AS (
  SELECT id, word, count(*) AS tf FROM (
    SELECT id, unnest(string_split(text, ' ')) AS word FROM cleaned WHERE _split = 'test')
  WHERE word IN (SELECT word FROM train_words) GROUP BY ALL),
sums AS (
  SELECT t.id, c.tag, sum(tf * ln((coalesce(n, 0) + 1)::DOUBLE / size)) AS s
  FROM test_words t CROSS JOIN classes c LEFT JOIN train_words w ON w.tag = c.tag AND w.word = t.word GROUP BY ALL),
scores AS (
  SELECT d.id, c.tag, c.class_index, prior + coalesce(s, 0) AS score
  FROM cleaned d CROSS JOIN classes c LEFT JOIN sums s ON s.id = d.id AND s.tag = c.tag WHERE _split = 'test'),
shares AS (SELECT *, exp(score - max(score) OVER (PARTITION BY id)) / 1.0 AS e FROM scores),
best AS (
  SELECT id, arg_max(class_index, e) AS class_index, arg_max(tag, e) AS tag, max(e) / sum(e) AS p FROM shares GROUP BY id),
predicted AS (
  SELECT d.id, d.tag, d.text, d.raw_text, CASE WHEN p > {THRESHOLD} THEN b.tag ELSE '{FALLBACK}' END AS predicted_tags,
    CASE WHEN p > {THRESHOLD} THEN b.class_index ELSE (SELECT class_index FROM classes WHERE tag = '{FALLBACK}') END AS pred_index
  FROM cleaned d JOIN best b USING (id))"""


def _bayes(spark, sf, raw: bool = False):
    train, test = _splits(spark, sf, raw)
    return fit_naive_bayes(train), test


@register(
    "text_model_predict",
    with_views(f"{_BAYES_SQL} SELECT CAST(pred_index AS BIGINT) AS pred_index, id, text AS input_text, predicted_tags FROM predicted", "v_text"),
)
def q_text_model_predict(spark, sf):
    """ML1 + ML2: naive Bayes, thresholded predictions with fallback and label decode."""
    model, test = _bayes(spark, sf)
    return MD.predict_tags(model, test, threshold=THRESHOLD, fallback=FALLBACK)


@register(
    "text_model_eval",
    with_views(
        f"""{_BAYES_SQL},
scored AS (SELECT tag AS y_true, predicted_tags AS y_pred, tag, raw_text AS text FROM predicted),
{_PRF_CTES},
{_slices_sql()}
SELECT 'overall' AS scope, 'overall' AS key, round(sum(support * precision) / sum(support), 9) AS precision,
  round(sum(support * recall) / sum(support), 9) AS recall, round(sum(support * f1) / sum(support), 9) AS f1,
  sum(support)::DOUBLE AS num_samples FROM prf
UNION ALL
SELECT 'per_class', label, round(precision, 9), round(recall, 9), round(f1, 9), support::DOUBLE FROM prf WHERE support > 0
UNION ALL
SELECT 'slices', slice, round(avg(hit), 9), round(avg(hit), 9), round(avg(hit), 9), count(*)::DOUBLE FROM slice_rows GROUP BY slice""",
        "v_text",
    ),
)
def q_text_model_eval(spark, sf):
    """ML3: evaluate naive Bayes on the test split (AG8 rows)."""
    model, test = _bayes(spark, sf, raw=True)
    rows = MD.evaluate_text_model(model, test, default_slices(text="raw_text"), threshold=THRESHOLD, fallback=FALLBACK)
    return rows.select("scope", "key", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "num_samples")


@register(
    "text_model_loss",
    with_views(
        f"""{_BAYES_SQL},
truth AS (
  SELECT s.id, max(score) AS top, max(score) FILTER (WHERE s.tag = d.tag) AS mine, list(score) AS all_scores
  FROM scores s JOIN cleaned d USING (id) GROUP BY s.id)
SELECT round(avg(ln(list_sum(list_transform(all_scores, lambda x: exp(x - top)))) + top - mine), 6) AS valid_loss,
  CAST(count(mine) AS BIGINT) AS n FROM truth""",
        "v_text",
    ),
)
def q_text_model_loss(spark, sf):
    """ML1: the validation loss of the fitted classifier."""
    model, test = _bayes(spark, sf)
    return model.log_loss(test, "id", "text", "tag").select(F.round("loss", 6).alias("valid_loss"), "n")


@register("text_model_logistic_eval")
def q_text_model_logistic_eval(spark, sf):
    """ML1 + ML3 with the MLlib pipeline: logistic regression over TF-IDF."""
    model, _, _, test = _fit(spark, sf, raw=True)
    slices = default_slices(text="raw_text")
    return MD.evaluate_text_model(model, test, slices, threshold=THRESHOLD, fallback=FALLBACK)


@register("text_model_tuning")
def q_text_model_tuning(spark, sf):
    """ML4 + SM10: random search over 4 hash-drawn trials, 2 at a time."""
    train, _ = _splits(spark, sf)
    return MD.tune_text_classifier(train, MD.trial_table(spark, 4), parallelism=2)


@register(
    "text_model_behavioral",
    with_views(
        f"""{_BAYES_SQL}
SELECT id * 2 AS case_id, 'invariance' AS kind, text AS input_a, text || ' !' AS input_b, CAST(NULL AS VARCHAR) AS expected,
  predicted_tags AS pred_a, predicted_tags AS pred_b, true AS passed FROM predicted
UNION ALL
SELECT id * 2 + 1, 'mft', text, NULL, tag, predicted_tags, NULL, predicted_tags = tag FROM predicted""",
        "v_text",
    ),
)
def q_text_model_behavioral(spark, sf):
    """ML5 + JN10: per test document an invariance case (punctuation added,
    which no training word has) and a minimum-functionality case (its own tag)."""
    model, test = _bayes(spark, sf)
    inv = test.select(
        (F.col("id") * 2).alias("case_id"), F.lit("invariance").alias("kind"), F.col("text").alias("input_a"),
        F.concat(F.col("text"), F.lit(" !")).alias("input_b"), F.lit(None).cast("string").alias("expected"),
    )
    mft = test.select(
        (F.col("id") * 2 + 1).alias("case_id"), F.lit("mft").alias("kind"), F.col("text").alias("input_a"),
        F.lit(None).cast("string").alias("input_b"), F.col("tag").alias("expected"),
    )
    return MD.behavioral_checks(model, inv.unionByName(mft), threshold=THRESHOLD, fallback=FALLBACK)


def _damped_scores(pdf):
    """Example scoring function: a damped copy of the target plus an offset."""
    import numpy as np

    y = np.stack(pdf["y"].to_numpy())
    pdf["score"] = list(y * 0.9 + 0.01)
    return pdf[["batch", "node", "node_type", "y", "score"]]


@register(
    "mesh_batch_scoring",
    with_views(
        """SELECT batch, round(sqrt(avg(CASE WHEN node_type IN (0, 5) THEN
    (y[1] - (y[1] * 0.9::DOUBLE + 0.01::DOUBLE)) * (y[1] - (y[1] * 0.9::DOUBLE + 0.01::DOUBLE))
  + (y[2] - (y[2] * 0.9::DOUBLE + 0.01::DOUBLE)) * (y[2] - (y[2] * 0.9::DOUBLE + 0.01::DOUBLE)) END)), 9) AS rmse
FROM v_mesh GROUP BY batch""",
        "v_mesh",
    ),
)
def q_mesh_batch_scoring(spark, sf):
    """ML6 + UD1: a user scoring function over Arrow batches, then the masked
    RMSE of the scores per batch."""
    from tessera.functions.arrays import sq_error
    from tessera.operators.mesh import loss_mask

    nodes = v_mesh(spark, sf).select("batch", "node", "node_type", "y")
    scored = MD.score_batches(nodes, _damped_scores, "batch long, node long, node_type long, y array<double>, score array<double>")
    err = sq_error(F.col("y"), F.col("score"))
    return scored.groupBy("batch").agg(F.round(F.sqrt(F.avg(F.when(loss_mask(F.col("node_type")), err))), 9).alias("rmse"))
