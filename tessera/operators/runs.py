"""Experiment store queries over ``runs``, ``artifacts`` and ``history`` tables
(SK3, SK5-SK8, WN7, WN9, JN9, FP5-FP7, ST-10, ST-11, SC15, AR11, AG24).

Everything is an aggregate or a join, so a run with a huge share of the rows
is reduced map-side (``min_by`` / ``max`` combine partially) instead of being
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.core import bucketed_rank, interval_hit


_RETENTION_SALTS = 32


class EmptyResultError(ValueError):
    pass


def assert_non_empty(df: DataFrame, what: str) -> DataFrame:
    """AG24: raise when ``df`` has no row (one cheap ``limit 1`` probe)."""
    if df.isEmpty():
        raise EmptyResultError(f"No runs matched {what}")
    return df


def best_run(runs: DataFrame, group: str, *, metric: str = "val_loss", sort_mode: str = "ASC",
             group_col: str = "run_group", id_col: str = "run_id") -> DataFrame:
    """SK3: ascending only when ``sort_mode`` is exactly "ASC", else descending;
    NULL metrics last; ties by id. Top-1 (``TakeOrderedAndProject``)."""
    m = F.col(metric).asc_nulls_last() if sort_mode == "ASC" else F.col(metric).desc_nulls_last()
    return runs.where(F.col(group_col) == F.lit(group)).orderBy(m, F.col(id_col)).limit(1)


def best_run_per_group(runs: DataFrame, *, metric: str = "val_loss", sort_mode: str = "ASC",
                       group_col: str = "run_group", id_col: str = "run_id") -> DataFrame:
    """SK3 for every group at once: one partial aggregate, no window."""
    sign = F.lit(1.0) if sort_mode == "ASC" else F.lit(-1.0)
    ranked = F.struct((sign * F.col(metric)).alias("m"), F.col(id_col).alias("i"))
    best = F.min(F.struct(ranked.alias("k"), F.col(id_col).alias("id"), F.col(metric).alias("v")))
    return (
        runs.where(F.col(metric).isNotNull())
        .groupBy(group_col)
        .agg(best.alias("b"))
        .select(group_col, F.col("b.id").alias(id_col), F.col("b.v").alias(metric))
    )


def has_tag(tag: str, tags: str = "tags") -> Column:
    """FP7."""
    return F.array_contains(F.col(tags), F.lit(tag))


def cleanup_sets(runs: DataFrame, tag: str = "delete", id_col: str = "run_id") -> tuple[DataFrame, DataFrame]:
    """SK7 + JN9: (runs to delete, surviving runs) — a dry run; the caller acts."""
    doomed = runs.where(has_tag(tag))
    survivors = runs.join(doomed.select(id_col), on=id_col, how="left_anti")
    return doomed, survivors


def retention(artifacts: DataFrame, *, artifact_type: str | None = None, id_col: str = "run_id",
              type_col: str = "type", ts_col: str = "created_at", tiebreak: list[str] | None = None) -> DataFrame:
    """SK8 + WN9: keep exactly one artifact per (run, type), the newest, and
    mark the rest ``delete``. "Newest" = max of ``(created_at, *tiebreak)``;
    rows that still tie are told apart by a hash of the row, equal rows by an
    arbitrary order. NULL runs and types are groups of their own.

    The newest value of a group is an aggregate, combined before the shuffle, and
    joined back. Only rows equal to it compete; the others are dealt over
    ``_RETENTION_SALTS`` tasks a group, so one run with a third of all artifacts
    is never in one task."""
    a = artifacts if artifact_type is None else artifacts.where(F.col(type_col) == F.lit(artifact_type))
    columns = a.columns
    a = a.withColumns({
        "__k": F.struct(F.col(id_col).alias("id"), F.col(type_col).alias("type")),
        "__o": F.struct(F.col(ts_col).alias("o0"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(tiebreak or [], 1)]),
        "__h": F.xxhash64(*columns),
    })
    newest = a.groupBy("__k").agg(F.max(F.struct("__o", "__h")).alias("__newest"))
    a = a.join(newest, on="__k").withColumn("__match", F.struct("__o", "__h") == F.col("__newest"))
    salt = F.when(~F.col("__match"), F.pmod("__h", F.lit(_RETENTION_SALTS)))
    equal = Window.partitionBy("__k", "__match", salt).orderBy("__match")
    keep = F.col("__match") & (F.row_number().over(equal) == 1)
    return a.select(*columns, F.when(keep, F.lit("keep")).otherwise(F.lit("delete")).alias("action"))


def retention_rank(artifacts: DataFrame, *, id_col: str = "run_id", type_col: str = "type",
                   ts_col: str = "created_at", tiebreak: list[str] | None = None) -> DataFrame:
    """WN9 with the full rank (newest = 1) for reports. Bucketed by day of
    ``created_at`` (descending), so one run with most artifacts is ranked in
    many tasks."""
    order = [F.col(ts_col).desc()] + [F.col(c).desc() for c in tiebreak or []]
    bucket = F.coalesce(-_day_number(F.col(ts_col)), F.lit(2**62))  # NULL is the oldest
    return bucketed_rank(artifacts, order=order, bucket=bucket, group_cols=[id_col, type_col], rank_col="rank")


def _day_number(ts: Column) -> Column:
    """Days since 1970-01-01 (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")


# Name builders (ST-10) -------------------------------------------------------

def run_name(run_id: Column) -> Column:
    return F.concat(F.lit("TorchTrainer_"), run_id.cast("string"))


def checkpoint_name(run_id: Column, alias: str | None = None) -> Column:
    base = F.concat(F.lit("checkpoint_"), run_name(run_id))
    return base if alias is None else F.concat(base, F.lit(":" + alias))


def project_path(entity: str, project: Column) -> Column:
    return F.concat(F.lit(entity + "/"), project)


def object_path(entity: str, project: Column, obj: Column) -> Column:
    return F.concat(project_path(entity, project), F.lit("/"), obj.cast("string"))


def verify_artifact_name(name: Column) -> Column:
    """ST-11: exactly one ':' (empty parts pass)."""
    return F.size(F.split(name, ":", -1)) == 2


def first_matching_run(runs: DataFrame, trials: DataFrame, *, trial_col: str = "trial_id",
                       id_col: str = "run_id") -> DataFrame:
    """SK6: for each trial id, the smallest run id whose name is
    ``TorchTrainer_{trial}``; trials without a run get NULL."""
    named = runs.select(run_name(F.col(id_col)).alias("__name"), F.col(id_col))
    firsts = named.groupBy("__name").agg(F.min(id_col).alias(id_col))
    return trials.withColumn("__name", run_name(F.col(trial_col))).join(firsts, on="__name", how="left").drop("__name")


def artifact_versions(artifacts: DataFrame, *, name_col: str = "name", ts_col: str = "created_at",
                      tiebreak: list[str] | None = None) -> DataFrame:
    """Version numbers per name (v0 oldest) and the ``latest`` alias."""
    order = [F.col(ts_col)] + [F.col(c) for c in tiebreak or []]
    bucket = _day_number(F.col(ts_col))
    v = bucketed_rank(artifacts, order=order, bucket=bucket, group_cols=[name_col], rank_col="version", size_col="__n")
    v = v.withColumn("version", F.col("version") - 1).withColumn("__maxv", F.col("__n") - 1).drop("__n")
    return v.withColumn(
        "aliases",
        F.when(F.col("version") == F.col("__maxv"), F.array(F.lit("latest"), F.concat(F.lit("v"), F.col("version").cast("string"))))
        .otherwise(F.array(F.concat(F.lit("v"), F.col("version").cast("string")))),
    ).drop("__maxv")


def resolve_artifacts(versioned: DataFrame, requests: DataFrame, ref_col: str = "ref", name_col: str = "name") -> DataFrame:
    """SC15: resolve ``name:alias`` references against versioned artifacts."""
    req = requests.withColumn("__n", F.substring_index(F.col(ref_col), ":", 1)).withColumn(
        "__a", F.substring_index(F.col(ref_col), ":", -1)
    )
    return req.join(
        versioned, (req["__n"] == versioned[name_col]) & F.array_contains(versioned["aliases"], req["__a"]), "inner"
    ).drop("__n", "__a")


# History -----------------------------------------------------------------------

def running_avg(history: DataFrame, *, run: str = "run_id", epoch: str = "epoch", step: str = "step",
                loss: str = "loss", out: str = "avg_loss", bucket_width: int = 4096) -> DataFrame:
    """WN7: average loss from the start of each epoch up to each step, as
    running sum / running count with bucketed prefix sums (a long epoch of
    one run is spread over many tasks)."""
    from tessera.operators.trajectory import bucketed_cumsum

    h = history.withColumn("__one", F.lit(1.0))
    h = bucketed_cumsum(h, [run, epoch], step, [loss, "__one"], ["__cs", "__cn"], bucket_width=bucket_width)
    return h.withColumn(out, F.col("__cs") / F.col("__cn")).drop("__one", "__cs", "__cn")


def epoch_summary(history: DataFrame, *, run: str = "run_id", epoch: str = "epoch", step: str = "step",
                  loss: str = "loss", lr: str = "lr") -> DataFrame:
    """SS1 (batch form): per (run, epoch) mean loss, last lr, last step, steps."""
    return history.groupBy(run, epoch).agg(
        F.avg(loss).alias("avg_loss"),
        F.max_by(lr, step).alias("last_lr"),
        F.max(step).alias("last_step"),
        F.count(F.lit(1)).cast("bigint").alias("n_steps"),
    )


def interval_steps(history: DataFrame, interval, step: str = "step") -> DataFrame:
    """FP5: steps at which an every-``interval`` action fires."""
    return history.where(interval_hit(F.col(step), interval))


def best_checkpoint(history: DataFrame, *, run: str = "run_id", step: str = "step", loss: str = "loss") -> DataFrame:
    """SK5: per run the step with the lowest loss (ties: earliest step), then
    the overall best run. Both are aggregates (no sort of the history). NULL
    losses never win: a run of NULL losses only has NULL best values."""
    measured = F.struct(F.col(loss).alias("loss"), F.col(step).alias("step"))
    per_run = history.groupBy(run).agg(F.min(F.when(F.col(loss).isNotNull(), measured)).alias("b"))
    per_run = per_run.select(run, F.col("b.loss").alias("best_loss"), F.col("b.step").alias("best_step"))
    overall = per_run.where(F.col("best_loss").isNotNull()).agg(F.min(F.struct("best_loss", run)).alias("o"))
    overall = overall.select(F.col("o." + run).alias("__best"))
    return per_run.join(F.broadcast(overall), on=F.col(run) == F.col("__best"), how="left").withColumn(
        "is_best", F.col("__best").isNotNull()
    ).drop("__best")


def dict_to_records(df: DataFrame, keys: list[str]) -> DataFrame:
    """AR11: columns of equal-length arrays -> one row per position
    (``arrays_zip`` + ``inline``); field names are the column names."""
    others = [c for c in df.columns if c not in keys]
    return df.select(*others, F.inline(F.arrays_zip(*[F.col(k) for k in keys])))
