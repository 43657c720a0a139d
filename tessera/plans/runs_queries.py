"""Checked queries over the experiment store views (V_runs, V_artifacts,
V_history) and the string / timestamp helpers (ST-10..ST-16)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_hash_hex, sql_hex_uniform
from tessera.operators import runs as R
from tessera.operators.models import trial_params
from tessera.plans.catalog import register
from tessera.plans.views import ARTIFACT_TIEBREAK, v_artifacts, v_history, v_runs, with_views

ENTITY = "ml-team"
TS_FMT_SQL = "%Y-%m-%d %H:%M:%S"


def _ts(col: str):
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss").alias(col)


_TB_SQL = ", ".join(ARTIFACT_TIEBREAK)


@register(
    "runs_best_per_group",
    with_views(
        """SELECT run_group, run_id, val_loss FROM (
  SELECT run_group, run_id, val_loss,
         row_number() OVER (PARTITION BY run_group ORDER BY val_loss, run_id) AS r
  FROM v_runs WHERE val_loss IS NOT NULL) WHERE r = 1""",
        "v_runs",
    ),
)
def q_runs_best_per_group(spark, sf):
    """SK3 (ASC) for every group: lowest val_loss, ties by run id."""
    return R.best_run_per_group(v_runs(spark, sf))


@register(
    "runs_best_per_group_desc",
    with_views(
        """SELECT run_group, run_id, val_loss FROM (
  SELECT run_group, run_id, val_loss,
         row_number() OVER (PARTITION BY run_group ORDER BY val_loss DESC, run_id) AS r
  FROM v_runs WHERE val_loss IS NOT NULL) WHERE r = 1""",
        "v_runs",
    ),
)
def q_runs_best_per_group_desc(spark, sf):
    """SK3 (any mode other than "ASC" sorts descending)."""
    return R.best_run_per_group(v_runs(spark, sf), sort_mode="DESC")


@register(
    "runs_best_single",
    with_views(
        """SELECT run_id, run_group, val_loss FROM v_runs WHERE run_group = '3-MEDIUM'
ORDER BY val_loss ASC NULLS LAST, run_id LIMIT 1""",
        "v_runs",
    ),
)
def q_runs_best_single(spark, sf):
    """SK3 + FP6 + AG24: best run of one group (top-1 is the feature)."""
    best = R.assert_non_empty(R.best_run(v_runs(spark, sf), "3-MEDIUM"), "group 3-MEDIUM")
    return best.select("run_id", "run_group", "val_loss")


@register(
    "runs_cleanup_doomed",
    with_views("SELECT run_id, project FROM v_runs WHERE list_contains(tags, 'delete')", "v_runs"),
)
def q_runs_cleanup_doomed(spark, sf):
    """SK7 + FP7: every run tagged "delete", over all projects."""
    doomed, _ = R.cleanup_sets(v_runs(spark, sf))
    return doomed.select("run_id", "project")


@register(
    "runs_cleanup_survivors",
    with_views(
        """SELECT project, CAST(count(*) AS BIGINT) AS n_runs FROM v_runs r
WHERE NOT EXISTS (SELECT 1 FROM v_runs d WHERE list_contains(d.tags, 'delete') AND d.run_id = r.run_id)
GROUP BY project""",
        "v_runs",
    ),
)
def q_runs_cleanup_survivors(spark, sf):
    """JN9: runs surviving the cleanup (left anti join), counted per project."""
    _, survivors = R.cleanup_sets(v_runs(spark, sf))
    return survivors.groupBy("project").agg(F.count(F.lit(1)).cast("bigint").alias("n_runs"))


@register(
    "runs_name_builders",
    with_views(
        f"""SELECT run_id, 'TorchTrainer_' || run_id AS run_name,
  'checkpoint_TorchTrainer_' || run_id AS checkpoint_name,
  'checkpoint_TorchTrainer_' || run_id || ':latest' AS checkpoint_ref,
  '{ENTITY}/' || project AS project_path,
  '{ENTITY}/' || project || '/' || run_id AS object_path,
  '{ENTITY}/' || project || '/checkpoint_TorchTrainer_' || run_id || ':latest' AS checkpoint_path
FROM v_runs""",
        "v_runs",
    ),
)
def q_runs_name_builders(spark, sf):
    """ST-10: run, checkpoint and path names."""
    r = v_runs(spark, sf)
    rid, proj = F.col("run_id"), F.col("project")
    return r.select(
        "run_id",
        R.run_name(rid).alias("run_name"),
        R.checkpoint_name(rid).alias("checkpoint_name"),
        R.checkpoint_name(rid, "latest").alias("checkpoint_ref"),
        R.project_path(ENTITY, proj).alias("project_path"),
        R.object_path(ENTITY, proj, rid).alias("object_path"),
        R.object_path(ENTITY, proj, R.checkpoint_name(rid, "latest")).alias("checkpoint_path"),
    )


@register(
    "runs_first_matching",
    with_views(
        """WITH trials AS (SELECT DISTINCT o_custkey AS trial_id FROM orders)
SELECT t.trial_id, (SELECT min(run_id) FROM v_runs r WHERE 'TorchTrainer_' || r.run_id = 'TorchTrainer_' || t.trial_id) AS run_id
FROM trials t""",
        "v_runs",
    ),
)
def q_runs_first_matching(spark, sf):
    """SK6: trial id -> first run named ``TorchTrainer_{trial}`` (NULL if none);
    trial ids are the customer keys of the orders table."""
    from tessera.sources.tables import table

    trials = table(spark, sf, "orders").select(F.col("o_custkey").alias("trial_id")).distinct()
    return R.first_matching_run(v_runs(spark, sf), trials)


@register(
    "artifacts_retention",
    with_views(
        f"""SELECT run_id, type, name, strftime(created_at, '{TS_FMT_SQL}') AS created_at, {_TB_SQL},
  CASE WHEN row_number() OVER (PARTITION BY run_id, type ORDER BY created_at DESC, {', '.join(c + ' DESC' for c in ARTIFACT_TIEBREAK)}) = 1
       THEN 'keep' ELSE 'delete' END AS action
FROM v_artifacts""",
        "v_artifacts",
    ),
)
def q_artifacts_retention(spark, sf):
    """SK8 + WN9: keep the newest artifact per (run, type), flag the rest."""
    out = R.retention(v_artifacts(spark, sf), tiebreak=ARTIFACT_TIEBREAK)
    return out.select("run_id", "type", "name", _ts("created_at"), *ARTIFACT_TIEBREAK, "action")


@register(
    "artifacts_retention_model_type",
    with_views(
        f"""SELECT run_id, name, CAST(row_number() OVER (PARTITION BY run_id ORDER BY created_at DESC, {', '.join(c + ' DESC' for c in ARTIFACT_TIEBREAK)}) AS BIGINT) AS rank
FROM v_artifacts WHERE type = 'R'""",
        "v_artifacts",
    ),
)
def q_artifacts_retention_model_type(spark, sf):
    """SK8 + FP6: one artifact type only, with the full newest-first rank."""
    a = v_artifacts(spark, sf).where(F.col("type") == "R")
    return R.retention_rank(a, tiebreak=ARTIFACT_TIEBREAK).select("run_id", "name", "rank")


@register(
    "artifacts_verify_name",
    with_views(
        """WITH refs AS (
  SELECT DISTINCT unnest([name, name || ':latest', name || ':v0:x', ':' || name]) AS ref FROM v_artifacts)
SELECT ref, len(string_split(ref, ':')) = 2 AS valid FROM refs""",
        "v_artifacts",
    ),
)
def q_artifacts_verify_name(spark, sf):
    """ST-11: ``name:alias`` format check (exactly one colon)."""
    a = v_artifacts(spark, sf)
    refs = a.select(
        F.explode(
            F.array(
                F.col("name"),
                F.concat("name", F.lit(":latest")),
                F.concat("name", F.lit(":v0:x")),
                F.concat(F.lit(":"), "name"),
            )
        ).alias("ref")
    ).distinct()
    return refs.select("ref", R.verify_artifact_name(F.col("ref")).alias("valid"))


@register(
    "artifacts_resolve_best",
    with_views(
        f"""WITH best AS (
  SELECT run_group, run_id FROM (
    SELECT run_group, run_id, row_number() OVER (PARTITION BY run_group ORDER BY val_loss, run_id) AS r
    FROM v_runs WHERE val_loss IS NOT NULL) WHERE r = 1),
ver AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY created_at, {_TB_SQL}) - 1 AS version,
         count(*) OVER (PARTITION BY name) - 1 AS maxv FROM v_artifacts)
SELECT b.run_group, 'checkpoint_TorchTrainer_' || b.run_id || ':latest' AS ref, v.run_id,
       CAST(v.version AS BIGINT) AS version, v.type, strftime(v.created_at, '{TS_FMT_SQL}') AS created_at
FROM best b JOIN ver v ON v.name = 'checkpoint_TorchTrainer_' || b.run_id AND v.version = v.maxv""",
        "v_runs",
        "v_artifacts",
    ),
)
def q_artifacts_resolve_best(spark, sf):
    """SK3 -> ST-10 -> SC15: resolve each group's best run checkpoint
    ``name:latest`` to the artifact version it points at."""
    best = R.best_run_per_group(v_runs(spark, sf))
    refs = best.select("run_group", R.checkpoint_name(F.col("run_id"), "latest").alias("ref"))
    versioned = R.artifact_versions(v_artifacts(spark, sf), tiebreak=ARTIFACT_TIEBREAK)
    res = R.resolve_artifacts(versioned, refs)
    return res.select("run_group", "ref", "run_id", "version", "type", _ts("created_at"))


# History ---------------------------------------------------------------------

@register(
    "history_running_avg",
    with_views(
        """SELECT run_id, step, round(avg(loss) OVER (PARTITION BY run_id, epoch ORDER BY step
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS avg_loss FROM v_history""",
        "v_history",
    ),
)
def q_history_running_avg(spark, sf):
    """WN7: running average loss within each epoch."""
    h = R.running_avg(v_history(spark, sf))
    return h.select("run_id", "step", F.round("avg_loss", 9).alias("avg_loss"))


@register(
    "history_epoch_summary",
    with_views(
        f"""SELECT run_id, strftime(epoch, '{TS_FMT_SQL}') AS epoch, round(avg(loss), 9) AS avg_loss,
  round(arg_max(lr, step), 9) AS last_lr, max(step) AS last_step, CAST(count(*) AS BIGINT) AS n_steps
FROM v_history GROUP BY run_id, epoch""",
        "v_history",
    ),
)
def q_history_epoch_summary(spark, sf):
    """SS1 (batch form): per (run, epoch) mean loss and last lr."""
    s = R.epoch_summary(v_history(spark, sf))
    return s.select(
        "run_id", _ts("epoch"), F.round("avg_loss", 9).alias("avg_loss"), F.round("last_lr", 9).alias("last_lr"),
        "last_step", "n_steps",
    )


@register(
    "history_interval_steps",
    with_views("SELECT run_id, step FROM v_history WHERE step % 20 = 0", "v_history"),
)
def q_history_interval_steps(spark, sf):
    """FP5: steps where an every-20-steps evaluation fires."""
    return R.interval_steps(v_history(spark, sf), 20).select("run_id", "step")


@register(
    "history_best_checkpoint",
    with_views(
        """WITH per_run AS (
  SELECT run_id, min(loss) AS best_loss, min(step) FILTER (WHERE loss = mn) AS best_step FROM (
    SELECT *, min(loss) OVER (PARTITION BY run_id) AS mn FROM v_history) GROUP BY run_id),
best AS (SELECT run_id FROM per_run ORDER BY best_loss, run_id LIMIT 1)
SELECT p.run_id, p.best_loss, p.best_step, p.run_id IN (SELECT run_id FROM best) AS is_best FROM per_run p""",
        "v_history",
    ),
)
def q_history_best_checkpoint(spark, sf):
    """SK5: best step per run by loss, and the single best run."""
    return R.best_checkpoint(v_history(spark, sf))


@register(
    "history_records",
    with_views("SELECT run_id, step, loss FROM v_history", "v_history"),
)
def q_history_records(spark, sf):
    """AR11: per-(run, epoch) column arrays turned back into records with
    ``arrays_zip`` + ``inline``."""
    h = v_history(spark, sf)
    cols = h.groupBy("run_id", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("step", "loss"))).alias("s")
    ).select("run_id", F.col("s.step").alias("step"), F.col("s.loss").alias("loss"))
    return R.dict_to_records(cols, ["step", "loss"])


@register(
    "events_timestamps",
    """SELECT event_id, strftime(ts, '%B %d, %Y %I:%M:%S %p') AS readable,
  strftime(ts, '%Y-%m-%d_%H-%M-%S') AS path_ts, strftime(ts, '%Y_%m_%d_%H_%M_%S') AS tune_ts FROM events""",
)
def q_events_timestamps(spark, sf):
    """ST-14 + ST-15: readable and path-safe timestamps."""
    from tessera.functions.strings import path_timestamp, readable_timestamp, tune_timestamp
    from tessera.sources.tables import table

    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", readable_timestamp(ts).alias("readable"), path_timestamp(ts).alias("path_ts"),
        tune_timestamp(ts).alias("tune_ts"),
    )


@register(
    "pages_url_parts",
    r"""SELECT page_id, regexp_extract(url, '([^/\\]+)[/\\]*$', 1) AS name,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages""",
)
def q_pages_url_parts(spark, sf):
    """ST-12 + ST-13: last path component and URI path."""
    from tessera.functions.strings import uri_path
    from tessera.functions.text import name_from_path
    from tessera.sources.tables import table

    return table(spark, sf, "pages").select(
        "page_id", name_from_path(F.col("url")).alias("name"), uri_path(F.col("url")).alias("path")
    )


@register(
    "events_config_parse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def q_events_config_parse(spark, sf):
    """ST-16: JSON text -> typed struct field."""
    from tessera.functions.strings import parse_config
    from tessera.sources.tables import table

    ev = table(spark, sf, "events")
    return ev.select("event_id", parse_config(F.col("props"), "k bigint")["k"].alias("k"))


def _drawn(name: str) -> str:
    return sql_hex_uniform(sql_hash_hex(["run_id"], f"1234:{name}"))


@register(
    "runs_trial_params",
    with_views(
        f"""SELECT run_id, round(0.3::DOUBLE + 0.6::DOUBLE * {_drawn('dropout_p')}, 9) AS dropout_p,
  round(exp({math.log(1e-5)!r}::DOUBLE + {math.log(5e-4) - math.log(1e-5)!r}::DOUBLE * {_drawn('lr')}), 12) AS lr,
  round(0.1::DOUBLE + 0.8::DOUBLE * {_drawn('lr_factor')}, 9) AS lr_factor,
  round(1.0::DOUBLE + 9.0::DOUBLE * {_drawn('lr_patience')}, 9) AS lr_patience FROM v_runs""",
        "v_runs",
    ),
)
def q_runs_trial_params(spark, sf):
    """SM10: the search space drawn for every run."""
    drawn = trial_params(v_runs(spark, sf), id_col="run_id")
    exact = {"lr": 12}
    return drawn.select("run_id", *[F.round(c, exact.get(c, 9)).alias(c) for c in drawn.columns if c != "run_id"])
