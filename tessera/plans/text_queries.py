"""Checked queries over the labelled-text view (V_text) and scores (V_logits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.catalog import register
from tessera.functions.text import STOPWORDS
from tessera.plans.sql_snippets import (
    sql_clean_text,
    sql_slice_nlp_llm,
    sql_slice_short,
    sql_str_list,
    sql_word_count,
)
from tessera.plans.text_eval import SEED, TEST_SIZE, cleaned_text, evaluate_text
from tessera.plans.views import with_views
from tessera.session import materialize

# ---------------------------------------------------------------------------
# Shared oracle fragments
_SPLIT_CTE = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY md5(CAST(id AS VARCHAR) || ':' || '{SEED}'), id) AS r,
         count(*) OVER (PARTITION BY tag) AS n
  FROM v_text),
split AS (
  SELECT * EXCLUDE (r, n), CASE WHEN r <= ceil({TEST_SIZE}::DOUBLE * n) THEN 'test' ELSE 'train' END AS _split
  FROM ranked)"""

_SCORED_CTE = """scored AS (
  SELECT s.id, s.tag AS y_true, s.tag AS tag, s.title || ' ' || s.description AS text, v.y_pred
  FROM split s JOIN v_text v ON s.id = v.id WHERE s._split = 'test')"""

_PRF_CTES = """pairs AS (SELECT y_true AS t, y_pred AS p, count(*) AS n FROM scored GROUP BY 1, 2),
lab AS (
  SELECT label, sum(tp) AS tp, sum(np) AS n_pred, sum(sup) AS support FROM (
    SELECT t AS label, CASE WHEN t = p THEN n ELSE 0 END AS tp, 0 AS np, n AS sup FROM pairs
    UNION ALL SELECT p, 0, n, 0 FROM pairs) GROUP BY label),
prf0 AS (
  SELECT label, tp, n_pred, support,
    CASE WHEN n_pred = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / n_pred END AS precision,
    CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / support END AS recall FROM lab),
prf AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
                 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM prf0)"""

_CLASSES_CTE = """classes AS (
  SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS class_index
  FROM (SELECT DISTINCT tag FROM v_text WHERE tag IS NOT NULL))"""


def _slices_sql() -> str:
    return f"""slice_rows AS (
  SELECT unnest(list_filter([CASE WHEN {sql_slice_nlp_llm('tag', 'text')} THEN 'nlp_llm' END,
                             CASE WHEN {sql_slice_short('text')} THEN 'short_text' END],
                            lambda x: x IS NOT NULL)) AS slice,
         CAST(y_true = y_pred AS INTEGER) AS hit
  FROM scored)"""


EVAL_SQL = with_views(
    f"""WITH {_SPLIT_CTE},
{_SCORED_CTE},
{_PRF_CTES},
{_CLASSES_CTE},
{_slices_sql()},
rows AS (
  SELECT 'overall' AS scope, 'overall' AS key,
         sum(support * precision) / sum(support) AS precision,
         sum(support * recall) / sum(support) AS recall,
         sum(support * f1) / sum(support) AS f1,
         sum(support)::DOUBLE AS num_samples FROM prf
  UNION ALL
  SELECT 'per_class', c.tag, coalesce(p.precision, 0.0), coalesce(p.recall, 0.0), coalesce(p.f1, 0.0),
         coalesce(p.support, 0)::DOUBLE
  FROM classes c LEFT JOIN prf p ON c.tag = p.label
  UNION ALL
  SELECT 'slices', slice, avg(hit)::DOUBLE, avg(hit)::DOUBLE, avg(hit)::DOUBLE, count(*)::DOUBLE
  FROM slice_rows GROUP BY slice)
SELECT scope, key, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, num_samples FROM rows""",
    "v_text",
)


@register("text_eval_metrics", EVAL_SQL)
def q_text_eval_metrics(spark, sf):
    """Flagship: AG8 flat metric table of the stratified test split."""
    return evaluate_text(spark, sf)


_TEXT_EXPR = "title || ' ' || description"


@register(
    "text_clean",
    with_views(f"SELECT id, {sql_clean_text(_TEXT_EXPR)} AS text FROM v_text", "v_text"),
)
def q_text_clean(spark, sf):
    """FP1 + ST-7: cleaned text feature per document."""
    return cleaned_text(spark, sf)


# ---------------------------------------------------------------------------
# Split, shuffle, sample (WN10, FP4, SO1, SK1, SK2)

def _split(spark, sf):
    from tessera.operators.split import stratified_split
    from tessera.plans.views import v_text

    return stratified_split(v_text(spark, sf), key="id", stratify="tag", test_size=TEST_SIZE, seed=SEED)


@register("text_split_assignment", with_views(f"WITH {_SPLIT_CTE} SELECT id, tag, _split FROM split", "v_text"))
def q_text_split_assignment(spark, sf):
    """WN10 + SO1: every row with its exact stratified split."""
    return _split(spark, sf).select("id", "tag", "_split")


@register(
    "text_split_counts",
    with_views(
        f"WITH {_SPLIT_CTE} SELECT tag, _split, CAST(count(*) AS BIGINT) AS n FROM split GROUP BY tag, _split",
        "v_text",
    ),
)
def q_text_split_counts(spark, sf):
    """WN10: per-class train/test counts (exact, ceil(0.2 n) test rows)."""
    return _split(spark, sf).groupBy("tag", "_split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register(
    "text_train_rows",
    with_views(f"WITH {_SPLIT_CTE} SELECT id, tag, title FROM split WHERE _split = 'train'", "v_text"),
)
def q_text_train_rows(spark, sf):
    """FP4: the train split, helper column dropped."""
    from tessera.operators.split import filter_split

    return filter_split(_split(spark, sf), "train").select("id", "tag", "title")


@register(
    "text_split_unshuffled",
    f"""SELECT id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY key DESC) <= ceil({TEST_SIZE}::DOUBLE * count(*) OVER (PARTITION BY source))
    THEN 'test' ELSE 'train' END AS _split
FROM (SELECT doc_id AS id, 'all' AS source, lang || ':' || text || ':' || doc_id AS key FROM documents)""",
)
def q_text_split_unshuffled(spark, sf):
    """WN10 without shuffling, on a text key with one class: the last rows by
    key go to test, ranked in buckets of sampled ranges."""
    from tessera.operators.split import stratified_split
    from tessera.sources.tables import table

    docs = table(spark, sf, "documents")
    keyed = docs.select(F.col("doc_id").alias("id"), F.lit("all").alias("source"), F.concat_ws(":", "lang", "text", "doc_id").alias("key"))
    return stratified_split(keyed, key="key", stratify="source", test_size=TEST_SIZE, shuffle=False).select("id", "_split")


@register(
    "text_shuffle_half",
    """SELECT doc_id AS id, lang FROM documents
ORDER BY md5(CAST(doc_id AS VARCHAR) || ':' || '1234'), doc_id LIMIT (SELECT count(*) // 2 FROM documents)""",
)
def q_text_shuffle_half(spark, sf):
    """SK2: half of a table, selected by counts and a filter."""
    from tessera.operators.core import take_sample
    from tessera.sources.tables import table

    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    return take_sample(docs, "id", docs.count() // 2, seed=SEED)


@register(
    "text_leakage",
    with_views(
        f"""WITH {_SPLIT_CTE}
SELECT _split, CAST(count(*) AS BIGINT) AS n_shared FROM split a
WHERE EXISTS (SELECT 1 FROM split b WHERE b._split <> a._split
              AND b.title = a.title AND b.description = a.description)
GROUP BY _split""",
        "v_text",
    ),
)
def q_text_leakage(spark, sf):
    """JN11: rows of each split whose (title, description) also occurs in the
    other split (left semi join on a digest of the two, so no text is shuffled)."""
    same = F.sha2(F.concat(F.length("title").cast("string"), F.lit(":"), "title", "description"), 256).alias("same")
    s = materialize(_split(spark, sf).select("_split", same))
    other = s.select("same", F.when(F.col("_split") == "train", "test").otherwise("train").alias("_split")).distinct()
    shared = s.join(other, on=["same", "_split"], how="left_semi")
    return shared.groupBy("_split").agg(F.count(F.lit(1)).cast("bigint").alias("n_shared"))


@register(
    "text_concat_splits",
    with_views(f"WITH {_SPLIT_CTE} SELECT id, title, _split FROM split", "v_text"),
)
def q_text_concat_splits(spark, sf):
    """SO1: the two splits apart and together again with their split column."""
    from tessera.operators.split import concat_splits, filter_split

    s = _split(spark, sf).select("id", "title", "_split")
    return concat_splits(filter_split(s, "train"), filter_split(s, "test"))


@register(
    "text_shuffle_take",
    with_views(
        f"""SELECT id, tag FROM v_text ORDER BY md5(CAST(id AS VARCHAR) || ':' || '{SEED}'), id LIMIT 100""",
        "v_text",
    ),
)
def q_text_shuffle_take(spark, sf):
    """SK1 + SK2: the first 100 rows of the seeded shuffle (top-n: the limit is the feature)."""
    from tessera.operators.core import take_sample
    from tessera.plans.views import v_text

    return take_sample(v_text(spark, sf), "id", 100, seed=SEED).select("id", "tag")


@register(
    "text_shuffle_rank",
    with_views(
        f"""SELECT id, CAST(row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':' || '{SEED}'), id) AS BIGINT) AS rank
FROM v_text""",
        "v_text",
    ),
)
def q_text_shuffle_rank(spark, sf):
    """SK1: each row's position in the seeded permutation (bucketed exact rank)."""
    from tessera.operators.core import hash_rank
    from tessera.plans.views import v_text

    return hash_rank(v_text(spark, sf).select("id"), "id", SEED)


# ---------------------------------------------------------------------------
# Class index, label lookup (AG1-AG3, JN1, JN2)

@register("text_distinct_tags", with_views("SELECT DISTINCT tag FROM v_text", "v_text"))
def q_text_distinct_tags(spark, sf):
    from tessera.operators.text import distinct_labels
    from tessera.plans.views import v_text

    return distinct_labels(v_text(spark, sf))


@register(
    "text_num_classes",
    with_views("SELECT CAST(count(DISTINCT tag) AS BIGINT) AS num_classes FROM v_text", "v_text"),
)
def q_text_num_classes(spark, sf):
    from tessera.operators.text import num_classes
    from tessera.plans.views import v_text

    return num_classes(v_text(spark, sf))


@register("text_class_index", with_views(f"WITH {_CLASSES_CTE} SELECT tag, CAST(class_index AS BIGINT) AS class_index FROM classes", "v_text"))
def q_text_class_index(spark, sf):
    from tessera.operators.text import fit_class_index
    from tessera.plans.views import v_text

    return fit_class_index(v_text(spark, sf))


@register(
    "text_label_encode",
    with_views(
        f"""WITH {_SPLIT_CTE},
tr AS (SELECT * FROM split WHERE _split = 'train'),
classes AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS class_index FROM (SELECT DISTINCT tag FROM tr))
SELECT v.id, v.tag, CAST(c.class_index AS BIGINT) AS class_index,
       coalesce(d.tag, 'unknown') AS predicted_tag
FROM v_text v LEFT JOIN classes c ON v.tag = c.tag
LEFT JOIN classes d ON d.class_index = (CASE WHEN v.y_pred = 'en' THEN 0 ELSE 7 END)""",
        "v_text",
    ),
)
def q_text_label_encode(spark, sf):
    """JN1 + JN2: encode with the class table fitted on the train split
    (unseen labels -> NULL), decode an index back to a name (no such index ->
    'unknown')."""
    from tessera.operators.split import filter_split
    from tessera.operators.text import decode_labels, encode_labels, fit_class_index
    from tessera.plans.views import v_text

    vt = v_text(spark, sf)
    tr = filter_split(_split(spark, sf), "train")
    classes = fit_class_index(tr)
    enc = encode_labels(vt.select("id", "tag", "y_pred"), classes)
    enc = enc.withColumn("pred_index", F.when(F.col("y_pred") == "en", 0).otherwise(7).cast("bigint"))
    dec = decode_labels(enc, classes, "pred_index")
    return dec.select("id", "tag", "class_index", F.coalesce("predicted_tag", F.lit("unknown")).alias("predicted_tag"))


# ---------------------------------------------------------------------------
# String functions (ST-1..ST-9, FP11-FP13)

@register(
    "text_word_count",
    with_views(
        f"SELECT id, CAST({sql_word_count(_TEXT_EXPR)} AS BIGINT) AS n_words FROM v_text",
        "v_text",
    ),
)
def q_text_word_count(spark, sf):
    """ST-9: whitespace token count of the raw text feature."""
    from tessera.functions.text import text_feature, word_count
    from tessera.plans.views import v_text

    vt = v_text(spark, sf, spread=True)
    return vt.select("id", word_count(text_feature(F.col("title"), F.col("description"))).cast("bigint").alias("n_words"))


@register(
    "text_slices",
    with_views(
        f"""SELECT id, unnest(list_filter([CASE WHEN {sql_slice_nlp_llm('tag', _TEXT_EXPR)} THEN 'nlp_llm' END,
                                      CASE WHEN {sql_slice_short(_TEXT_EXPR)} THEN 'short_text' END],
                                     lambda x: x IS NOT NULL)) AS slice FROM v_text""",
        "v_text",
    ),
)
def q_text_slices(spark, sf):
    """FP11 + FP12 + FP13: long form (id, slice) of slice membership."""
    from tessera.operators.metrics import slice_flags
    from tessera.plans.text_eval import default_slices
    from tessera.plans.views import v_text

    vt = v_text(spark, sf, spread=True).withColumn("text", F.concat("title", F.lit(" "), "description"))
    return slice_flags(vt, default_slices(), "id")


@register(
    "text_stopwords_lower",
    with_views(
        # RE2 knows only ASCII word boundaries, so letters and digits beyond ASCII are
        # wrapped in Q (absent from lower-cased text) while the pattern is applied.
        r"""SELECT id, replace(regexp_replace(
    regexp_replace(lower(title || description), '([^\x00-\x7F\p{Z}\p{P}\p{S}\p{M}\p{C}])', 'Q\1Q', 'g'),
    '\b(""" + "|".join(STOPWORDS).replace("'", "''") + r""")\b[\t-\r\x1c- \x{85}\p{Z}]*', ' ', 'g'), 'Q', '') AS t
FROM v_text""",
        "v_text",
    ),
)
def q_text_stopwords_lower(spark, sf):
    """ST-1 + ST-2: lower-case, then stop words replaced by a space."""
    from tessera.functions.text import remove_stopwords
    from tessera.plans.views import v_text

    return v_text(spark, sf, spread=True).select("id", remove_stopwords(F.lower(F.concat("title", "description"))).alias("t"))


@register(
    "text_punct_steps",
    with_views(
        r"""SELECT id,
  regexp_replace(text, '([!"''#$%&()*\+,\-./:;<=>?@\\\[\]^_`{|}~])', ' \1 ', 'g') AS padded,
  regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g') AS alnum,
  trim(regexp_replace(text, ' +', ' ', 'g')) AS collapsed,
  regexp_replace(text, 'http\S+', '', 'g') AS nolinks
FROM (SELECT id, title || description AS text FROM v_text)""",
        "v_text",
    ),
)
def q_text_punct_steps(spark, sf):
    """ST-3..ST-6 one by one on the whole text."""
    from tessera.functions.text import collapse_spaces, pad_punctuation, remove_links, strip_non_alnum
    from tessera.plans.views import v_text

    t = F.concat("title", "description")
    return v_text(spark, sf, spread=True).select(
        "id",
        pad_punctuation(t).alias("padded"),
        strip_non_alnum(t).alias("alnum"),
        collapse_spaces(t).alias("collapsed"),
        remove_links(t).alias("nolinks"),
    )


# ---------------------------------------------------------------------------
# Metrics one by one (AG4-AG7, SK4)

def _scored(spark, sf):
    from tessera.plans.text_eval import scored_test_rows

    return scored_test_rows(spark, sf)


_METRIC_BASE = f"WITH {_SPLIT_CTE},\n{_SCORED_CTE},\n{_PRF_CTES}"


@register(
    "text_confusion_counts",
    with_views(
        _METRIC_BASE + "\nSELECT label, CAST(tp AS BIGINT) AS tp, CAST(n_pred AS BIGINT) AS n_pred, "
        "CAST(support AS BIGINT) AS support FROM lab",
        "v_text",
    ),
)
def q_text_confusion_counts(spark, sf):
    """AG4 + SO3: tp / predicted / support over truth ∪ prediction labels."""
    from tessera.operators.metrics import confusion_counts

    return confusion_counts(_scored(spark, sf))


@register(
    "text_overall_metrics",
    with_views(
        _METRIC_BASE
        + """
SELECT round(sum(support * precision) / sum(support), 9) AS precision,
       round(sum(support * recall) / sum(support), 9) AS recall,
       round(sum(support * f1) / sum(support), 9) AS f1, sum(support)::DOUBLE AS num_samples FROM prf""",
        "v_text",
    ),
)
def q_text_overall_metrics(spark, sf):
    """AG5: support-weighted precision, recall, F1."""
    from tessera.operators.metrics import overall_metrics

    o = overall_metrics(_scored(spark, sf))
    return o.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "num_samples")


@register(
    "text_per_class_metrics",
    with_views(
        _METRIC_BASE
        + f""",
{_CLASSES_CTE},
pc AS (
  SELECT c.tag AS class, CAST(c.class_index AS BIGINT) AS class_index,
         coalesce(p.precision, 0.0) AS precision, coalesce(p.recall, 0.0) AS recall,
         coalesce(p.f1, 0.0) AS f1, coalesce(p.support, 0)::DOUBLE AS num_samples
  FROM classes c LEFT JOIN prf p ON c.tag = p.label)
SELECT class, class_index, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, num_samples,
       CAST(row_number() OVER (ORDER BY f1 DESC, class_index) AS BIGINT) AS rank FROM pc""",
        "v_text",
    ),
)
def q_text_per_class_metrics(spark, sf):
    """AG6 + SK4: per-class metrics ranked by F1 descending."""
    from tessera.operators.metrics import per_class_metrics
    from tessera.operators.text import fit_class_index
    from tessera.plans.views import v_text

    pc = per_class_metrics(_scored(spark, sf), fit_class_index(v_text(spark, sf)))
    return pc.select(
        "class", "class_index", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "num_samples", "rank"
    )


@register(
    "text_slice_metrics",
    with_views(
        _METRIC_BASE
        + f""",
{_slices_sql()}
SELECT slice, round(avg(hit), 9) AS precision, round(avg(hit), 9) AS recall, round(avg(hit), 9) AS f1,
       CAST(count(*) AS BIGINT) AS num_samples FROM slice_rows GROUP BY slice""",
        "v_text",
    ),
)
def q_text_slice_metrics(spark, sf):
    """AG7: micro metrics per non-empty slice."""
    from tessera.operators.metrics import slice_metrics
    from tessera.plans.text_eval import default_slices

    s = slice_metrics(_scored(spark, sf), default_slices())
    return s.select("slice", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "num_samples")


DOCUMENT_SQL = with_views(
    f"""WITH {_SPLIT_CTE},
{_SCORED_CTE},
{_PRF_CTES},
{_CLASSES_CTE},
{_slices_sql()},
rows AS (
  SELECT 'overall' AS scope, 'overall' AS key, 0 AS place, sum(support * precision) / sum(support) AS precision,
    sum(support * recall) / sum(support) AS recall, sum(support * f1) / sum(support) AS f1, sum(support)::DOUBLE AS num_samples FROM prf
  UNION ALL
  SELECT 'per_class', c.tag, class_index, coalesce(p.precision, 0.0), coalesce(p.recall, 0.0), coalesce(p.f1, 0.0),
    coalesce(p.support, 0)::DOUBLE FROM classes c LEFT JOIN prf p ON c.tag = p.label
  UNION ALL
  SELECT 'slices', slice, CASE slice WHEN 'nlp_llm' THEN 0 ELSE 1 END, avg(hit), avg(hit), avg(hit), count(*)::DOUBLE
  FROM slice_rows GROUP BY slice)
SELECT 'January 01, 2024 12:00:00 AM' AS timestamp, 'r0' AS run_id, 'e0' AS eval_run_id, scope,
  CAST(row_number() OVER (PARTITION BY scope ORDER BY CASE WHEN scope = 'per_class' THEN -f1 ELSE 0 END, place) - 1 AS INTEGER) AS position,
  key, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, num_samples FROM rows""",
    "v_text",
)


def evaluation_of(spark, sf):
    """The evaluation document of the test split, at a fixed time and for fixed runs."""
    from tessera.functions.strings import readable_timestamp
    from tessera.operators.metrics import evaluation_document
    from tessera.plans.text_eval import evaluation_rows

    at = readable_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return evaluation_document(evaluation_rows(spark, sf), timestamp=at, run_id=F.lit("r0"), eval_run_id=F.lit("e0"))


def rounded_rows(documents):
    from tessera.operators.metrics import document_rows

    rows = document_rows(documents)
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@register("text_metric_document", DOCUMENT_SQL)
def q_text_metric_document(spark, sf):
    """AG8 + AR12: the nested document, classes by F1, read off in its order."""
    return rounded_rows(evaluation_of(spark, sf))


# ---------------------------------------------------------------------------
# Scores / logits (AR1-AR3, SM11, AG17-AG20, JN2)

from tessera.plans.views import LOGIT_CLASSES, LOGIT_FALLBACK, LOGIT_THRESHOLD  # noqa: E402

_LOGIT_PRED_SQL = with_views(
    f"""SELECT key,
  CAST(list_position(z, list_max(z)) - 1 AS BIGINT) AS argmax_index,
  CAST(CASE WHEN list_max(z) > {LOGIT_THRESHOLD}::DOUBLE THEN list_position(z, list_max(z)) - 1
            ELSE {LOGIT_FALLBACK} END AS BIGINT) AS pred_index,
  'c' || CAST(CASE WHEN list_max(z) > {LOGIT_THRESHOLD}::DOUBLE THEN list_position(z, list_max(z)) - 1
            ELSE {LOGIT_FALLBACK} END AS VARCHAR) AS pred_class,
  list_max(z) > {LOGIT_THRESHOLD}::DOUBLE AS confident
FROM v_logits""",
    "v_logits",
)


def _class_names(spark):
    return spark.range(LOGIT_CLASSES).select(
        F.col("id").alias("pred_index"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("pred_class")
    )


@register("logits_predict", _LOGIT_PRED_SQL)
def q_logits_predict(spark, sf):
    """AR1 + AR2 + SM11 + JN2: argmax, thresholded argmax with fallback, decode."""
    from tessera.functions.arrays import argmax, thresholded_argmax
    from tessera.plans.views import v_logits

    lg = v_logits(spark, sf)
    scored = lg.select(
        "key",
        argmax("z").alias("argmax_index"),
        thresholded_argmax("z", LOGIT_THRESHOLD, LOGIT_FALLBACK).alias("pred_index"),
        (F.array_max("z") > F.lit(LOGIT_THRESHOLD)).alias("confident"),
    )
    return scored.join(F.broadcast(_class_names(spark)), on="pred_index", how="left")


@register(
    "logits_one_hot",
    with_views(
        f"SELECT key, list_transform(range(0, {LOGIT_CLASSES}), lambda i: CASE WHEN i = target THEN 1.0 ELSE 0.0 END) AS onehot FROM v_logits",
        "v_logits",
    ),
)
def q_logits_one_hot(spark, sf):
    """AR3: one-hot target vectors."""
    from tessera.functions.arrays import one_hot
    from tessera.plans.views import v_logits

    return v_logits(spark, sf).select("key", one_hot(F.col("target"), LOGIT_CLASSES).alias("onehot"))


@register(
    "logits_group_centred",
    with_views(
        "SELECT key, round(list_max(z) - avg(list_max(z)) OVER (PARTITION BY target), 9) AS top FROM v_logits", "v_logits"
    ),
)
def q_logits_group_centred(spark, sf):
    """UD2 + AG23: a pandas function per group: top scores less their mean in the class."""
    from tessera.operators.udf import map_groups
    from tessera.plans.views import v_logits

    def centre(pdf):
        return pdf.assign(top=pdf["top"] - pdf["top"].mean())[["key", "top"]]

    top = v_logits(spark, sf).select("key", "target", F.array_max("z").alias("top"))
    return map_groups(top, ["target"], centre, "key long, top double").select("key", F.round("top", 9).alias("top"))


BATCH_SIZE = 64
_BATCH_CTE = f"""b AS (
  SELECT *, CAST(floor((row_number() OVER (ORDER BY md5(CAST(key AS VARCHAR) || ':' || '0'), key) - 1) / {BATCH_SIZE}) AS BIGINT) AS batch
  FROM v_logits)"""


@register("logits_batches", with_views(f"WITH {_BATCH_CTE} SELECT key, batch FROM b", "v_logits"))
def q_logits_batches(spark, sf):
    """AG20: fixed-size batches of 64 in a stable hashed order (last one short)."""
    from tessera.operators.core import fixed_batches
    from tessera.plans.views import v_logits

    return fixed_batches(v_logits(spark, sf), "key", BATCH_SIZE).select("key", "batch")


_BCE_ROW = (
    f"list_sum(list_transform(range(0, {LOGIT_CLASSES}), lambda i: greatest(z[i + 1], 0.0) - z[i + 1] * "
    "(CASE WHEN i = target THEN 1.0 ELSE 0.0 END) + ln(1.0 + exp(-abs(z[i + 1])))))"
)


@register(
    "logits_bce_per_batch",
    with_views(
        f"WITH {_BATCH_CTE} SELECT batch, round(sum({_BCE_ROW}) / (count(*) * {LOGIT_CLASSES}), 9) AS loss FROM b GROUP BY batch",
        "v_logits",
    ),
)
def q_logits_bce_per_batch(spark, sf):
    """AG18: mean BCE-with-logits per batch over rows x classes."""
    return _bce_batches(spark, sf).select("batch", F.round("loss", 9).alias("loss"))


def _bce_batches(spark, sf):
    from tessera.operators.core import fixed_batches
    from tessera.operators.losses import batch_means, bce_with_logits_sum
    from tessera.plans.views import v_logits

    b = fixed_batches(v_logits(spark, sf), "key", BATCH_SIZE)
    b = b.withColumn("__l", bce_with_logits_sum("z", "target", LOGIT_CLASSES))
    return batch_means(b, "batch", F.col("__l"), F.lit(float(LOGIT_CLASSES)))


@register(
    "logits_bce_running_mean",
    with_views(
        f"""WITH {_BATCH_CTE}, pb AS (SELECT batch, sum({_BCE_ROW}) / (count(*) * {LOGIT_CLASSES}) AS loss FROM b GROUP BY batch)
SELECT round(avg(loss), 9) AS avg_loss, CAST(count(*) AS BIGINT) AS num_batches FROM pb""",
        "v_logits",
    ),
)
def q_logits_bce_running_mean(spark, sf):
    """AG19: running mean of batch losses = mean of batch means."""
    from tessera.operators.losses import running_mean_of_batches

    r = running_mean_of_batches(_bce_batches(spark, sf))
    return r.select(F.round("avg_loss", 9).alias("avg_loss"), "num_batches")


# ---------------------------------------------------------------------------
# Vocabulary encoding and padding (AR13, AR5, AR6, AG20, AG22)

_CLEAN_CTE = f"cleaned AS (SELECT id, {sql_clean_text(_TEXT_EXPR)} AS text FROM v_text)"
_VOCAB_CTE = """toks AS (
  SELECT id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
  FROM (SELECT id, string_split(text, ' ') AS t FROM cleaned)),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS BIGINT) AS token_id,
         CAST(count(*) AS BIGINT) AS count
  FROM toks WHERE token <> '' GROUP BY token)"""


@register("text_vocabulary", with_views(f"WITH {_CLEAN_CTE}, {_VOCAB_CTE} SELECT token, token_id, count FROM vocab", "v_text"))
def q_text_vocabulary(spark, sf):
    """AR13: corpus vocabulary, ids by frequency (0 = pad, 1 = unknown)."""
    from tessera.operators.text import build_vocabulary

    return build_vocabulary(cleaned_text(spark, sf))


@register(
    "text_encode_pad",
    with_views(
        f"""WITH {_CLEAN_CTE}, {_VOCAB_CTE},
enc AS (
  SELECT c.id, coalesce(list(coalesce(v.token_id, 1) ORDER BY t.pos) FILTER (WHERE t.token IS NOT NULL), []) AS ids
  FROM cleaned c LEFT JOIN (SELECT * FROM toks WHERE token <> '') t ON c.id = t.id
  LEFT JOIN vocab v ON t.token = v.token GROUP BY c.id),
b AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':' || '0'), id) - 1) / 64) AS BIGINT) AS batch FROM enc),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS max_len FROM b)
SELECT id, batch, CAST(max_len AS INTEGER) AS max_len,
  list_concat(ids, list_transform(range(max_len - len(ids)), lambda i: CAST(0 AS BIGINT))) AS ids,
  list_concat(list_transform(range(len(ids)), lambda i: 1), list_transform(range(max_len - len(ids)), lambda i: 0)) AS masks
FROM m""",
        "v_text",
    ),
)
def q_text_encode_pad(spark, sf):
    """AR13 + AG20 + AG22 + AR5 + AR6: token ids per document, padded to the
    longest row of its batch of 64, with the attention mask."""
    from tessera.operators.core import fixed_batches
    from tessera.operators.text import build_vocabulary, encode_tokens, pad_batch

    cl = materialize(cleaned_text(spark, sf))  # read by the vocabulary and by the encoder
    enc = materialize(encode_tokens(cl, build_vocabulary(cl), "id").drop("text"))  # counted, ranked and padded
    b = fixed_batches(enc, "id", 64)
    return pad_batch(b, "batch", "ids").select("id", "batch", F.col("max_len").cast("int").alias("max_len"), "ids", "masks")


@register(
    "text_preprocess",
    with_views(
        f"""WITH {_CLASSES_CTE}
SELECT v.id, {sql_clean_text(_TEXT_EXPR)} AS text, v.tag, CAST(c.class_index AS BIGINT) AS class_index
FROM v_text v LEFT JOIN classes c ON v.tag = c.tag""",
        "v_text",
    ),
)
def q_text_preprocess(spark, sf):
    """UD5 + UD4: text feature, cleaning, column drop / reorder, label
    encoding with the fitted class index."""
    from tessera.operators.models import ClassIndexer
    from tessera.operators.text import preprocess
    from tessera.plans.views import v_text

    vt = v_text(spark, sf, spread=True).drop("y_pred")
    model = ClassIndexer().fit(vt)
    classes = spark.createDataFrame(list(model.class_to_index.items()), "tag string, class_index long")
    return preprocess(vt, classes, keep=["id"]).select("id", "text", "tag", "class_index")


@register(
    "text_preprocess_tokens",
    with_views(
        f"""WITH {_CLEAN_CTE}, {_VOCAB_CTE}, {_CLASSES_CTE},
enc AS (
  SELECT c.id, coalesce(list(coalesce(v.token_id, 1) ORDER BY t.pos) FILTER (WHERE t.token IS NOT NULL), []) AS ids
  FROM cleaned c LEFT JOIN (SELECT * FROM toks WHERE token <> '') t ON c.id = t.id
  LEFT JOIN vocab v ON t.token = v.token GROUP BY c.id),
b AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':' || '0'), id) - 1) / 64) AS BIGINT) AS batch FROM enc),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS max_len FROM b)
SELECT m.id, batch,
  list_concat(ids, list_transform(range(max_len - len(ids)), lambda i: CAST(0 AS BIGINT))) AS ids,
  list_concat(list_transform(range(len(ids)), lambda i: 1), list_transform(range(max_len - len(ids)), lambda i: 0)) AS masks,
  CAST(c.class_index AS BIGINT) AS targets
FROM m JOIN v_text v ON v.id = m.id LEFT JOIN classes c ON v.tag = c.tag""",
        "v_text",
    ),
)
def q_text_preprocess_tokens(spark, sf):
    """UD5: ids, masks and targets of every text in one call."""
    from tessera.operators.text import fit_class_index, preprocess_tokens
    from tessera.plans.views import v_text

    vt = v_text(spark, sf, spread=True).drop("y_pred")
    return preprocess_tokens(vt, fit_class_index(vt))


# ---------------------------------------------------------------------------
# Slices over the other text tables (benchmark items, conversation turns)

@register(
    "benchmark_slices",
    f"""SELECT item_id, {sql_word_count('text')} < 8 AS short_text,
  (contains(lower(text), 'transformer') OR contains(lower(text), 'llm') OR contains(lower(text), 'bert')) AS mentions_terms,
  CAST({sql_word_count('text')} AS BIGINT) AS n_words FROM benchmark""",
)
def q_benchmark_slices(spark, sf):
    """FP12 + ST-8 + ST-9 on the benchmark items."""
    from tessera.functions.text import LLM_TERMS, any_term, slice_short_text, word_count
    from tessera.sources.tables import table

    b = table(spark, sf, "benchmark")
    return b.select(
        "item_id", slice_short_text(F.col("text")).alias("short_text"),
        any_term(F.col("text"), LLM_TERMS).alias("mentions_terms"), word_count(F.col("text")).cast("bigint").alias("n_words"),
    )


@register(
    "conversation_slice_counts",
    f"""SELECT role, CAST(count(*) FILTER (WHERE {sql_word_count('text')} < 8) AS BIGINT) AS n_short,
  CAST(count(*) AS BIGINT) AS n_turns, CAST(sum({sql_word_count('text')}) AS BIGINT) AS n_words
FROM conversations GROUP BY role""",
)
def q_conversation_slice_counts(spark, sf):
    """FP12 + ST-9 per conversation role: short turns and word totals."""
    from tessera.functions.text import slice_short_text, word_count
    from tessera.sources.tables import table

    c = table(spark, sf, "conversations")
    return c.groupBy("role").agg(
        F.count_if(slice_short_text(F.col("text"))).cast("bigint").alias("n_short"),
        F.count(F.lit(1)).cast("bigint").alias("n_turns"),
        F.sum(word_count(F.col("text"))).cast("bigint").alias("n_words"),
    )


@register(
    "labels_join_coverage",
    """SELECT
  CAST((SELECT count(DISTINCT d.doc_id) FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)) AS BIGINT) AS n_matched,
  CAST((SELECT count(DISTINCT d.doc_id) FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)) AS BIGINT) AS n_only_left,
  CAST((SELECT count(DISTINCT l.doc_id) FROM labels l WHERE l.doc_id NOT IN (SELECT doc_id FROM documents)) AS BIGINT) AS n_only_right""",
)
def q_labels_join_coverage(spark, sf):
    """JN7 strict check: documents vs quality labels matched by key, and the
    keys present on one side only (left anti both ways)."""
    from tessera.operators.metrics import join_coverage
    from tessera.sources.tables import table

    return join_coverage(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
