"""Data-quality suite over the labelled-text view (DQ1-DQ7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.catalog import register
from tessera.plans.views import v_text, with_views

TAGS = ["en", "fr", "de", "es"]
_TAGS_SQL = ", ".join(f"'{t}'" for t in TAGS)


def _text_table(spark, sf):
    vt = v_text(spark, sf).drop("y_pred")
    return vt.withColumn("text", F.concat("title", F.lit(" "), "description"))


def _dup_sql(cols: str) -> str:
    nn = " OR ".join(f"{c} IS NOT NULL" for c in cols.split(","))
    return f"(SELECT coalesce(sum(k) FILTER (WHERE k > 1), 0) FROM (SELECT count(*) AS k FROM t WHERE {nn} GROUP BY {cols}))"


_SUITE_SQL = f"""WITH t AS (SELECT id, created_on, title, description, tag, title || ' ' || description AS text FROM v_text),
checks AS (
  SELECT 'expect_table_columns_to_match_ordered_list' AS expectation, 'id,created_on,title,description,tag,text' AS "column",
         true AS success, CAST(0 AS BIGINT) AS unexpected_count
  UNION ALL
  SELECT 'expect_column_values_to_be_in_set', 'tag', count(*) FILTER (WHERE tag IS NOT NULL AND tag NOT IN ({_TAGS_SQL})) = 0,
         count(*) FILTER (WHERE tag IS NOT NULL AND tag NOT IN ({_TAGS_SQL})) FROM t
  UNION ALL
  SELECT 'expect_compound_columns_to_be_unique', 'title,description', {_dup_sql('title,description')} = 0,
         {_dup_sql('title,description')}
  UNION ALL
  SELECT 'expect_column_values_to_not_be_null', 'tag', count(*) FILTER (WHERE tag IS NULL) = 0, count(*) FILTER (WHERE tag IS NULL) FROM t
  UNION ALL
  SELECT 'expect_column_values_to_be_unique', 'id', {_dup_sql('id')} = 0, {_dup_sql('id')}
  UNION ALL
  SELECT 'expect_column_values_to_be_of_type', 'title', true, CAST(0 AS BIGINT))"""


@register(
    "dq_suite",
    with_views(_SUITE_SQL + "\nSELECT expectation, \"column\", success, CAST(unexpected_count AS BIGINT) AS unexpected_count FROM checks", "v_text"),
)
def q_dq_suite(spark, sf):
    """DQ1-DQ6: one row per expectation on the labelled-text table."""
    return Q.default_text_suite(_text_table(spark, sf), TAGS)


@register(
    "dq_suite_result",
    with_views(
        _SUITE_SQL
        + "\nSELECT bool_and(success) AS success, CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS n_failed,"
        " CAST(count(*) AS BIGINT) AS n_checks FROM checks",
        "v_text",
    ),
)
def q_dq_suite_result(spark, sf):
    """DQ7: suite verdict (the reference asserts ``success``)."""
    return Q.suite_result(Q.default_text_suite(_text_table(spark, sf), TAGS))
