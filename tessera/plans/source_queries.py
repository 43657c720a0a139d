"""Queries that round-trip the given tables through the sources and sinks
(SC1-SC15): the data is derived from the tables by Spark, written to the
shared checkpoint folder, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.catalog import register
from tessera.plans.text_queries import DOCUMENT_SQL, evaluation_of, rounded_rows
from tessera.plans.views import v_history, v_text, v_traj, with_views
from tessera.session import materialize, scratch_path
from tessera.sources import files as FS
from tessera.sources import flat_tensor as FT
from tessera.sources import history_store as HS
from tessera.sources import store as ST
from tessera.sources import tensor_store as TS
from tessera.sources.csv_split import read_csv_split


#: Bytes of text that one task writes to one CSV file: several read blocks, whatever the table.
CSV_FILE_BYTES = 512 << 20


@register("csv_roundtrip", with_views("SELECT id, tag, title, description FROM v_text", "v_text"))
def q_csv_roundtrip(spark, sf):
    """SC1: labelled table written as header CSV (multi-line quoted text) and
    read back with an explicit schema."""
    path = scratch_path(spark, "csv")
    FS.write_csv(v_text(spark, sf).drop("y_pred"), path)
    return FS.read_csv(spark, path).select("id", "tag", "title", "description")


@register("csv_split_roundtrip", with_views("SELECT id, tag, title, description FROM v_text", "v_text"))
def q_csv_split_roundtrip(spark, sf):
    """SC1: the same table as one large CSV file, or several of about ``CSV_FILE_BYTES`` where it is larger, read in
    byte blocks by many tasks."""
    path = scratch_path(spark, "csv-one")
    rows = v_text(spark, sf).drop("y_pred")
    size = rows.agg(F.sum(F.octet_length("title") + F.octet_length("description"))).first()[0] or 0
    FS.write_csv(rows.coalesce(max(1, -(-size // CSV_FILE_BYTES))), path)
    return read_csv_split(spark, path).select("id", "tag", "title", "description")


@register(
    "csv_sample",
    with_views("SELECT id, tag FROM v_text ORDER BY md5(CAST(id AS VARCHAR) || ':' || '1234'), id LIMIT 50", "v_text"),
)
def q_csv_sample(spark, sf):
    """SC1 + SK2: ``num_samples`` rows of the seeded shuffle at load time."""
    path = scratch_path(spark, "csv")
    FS.write_csv(v_text(spark, sf).drop("y_pred"), path)
    return FS.read_csv(spark, path, num_samples=50).select("id", "tag")


@register(
    "flat_tensor_roundtrip",
    with_views(
        """SELECT CAST(particle AS INTEGER) AS traj_id, CAST(frame AS INTEGER) AS frame,
  CAST(pos[1] AS FLOAT)::DOUBLE AS x0, CAST(pos[2] AS FLOAT)::DOUBLE AS x1,
  CAST(particle % 9 AS BIGINT) AS particle_type FROM v_traj""",
        "v_traj",
    ),
)
def q_flat_tensor_roundtrip(spark, sf):
    """SC4 + SC5 + SC8 + JN5: every particle track exported as float32 chunk
    files with a manifest, then scanned back by the flat-trajectory data source
    (one input partition per trajectory frame range) and joined to its types."""
    path = scratch_path(spark, "traj")
    tracks = v_traj(spark, sf).select(
        F.col("particle").cast("int").alias("traj_id"), F.col("frame").cast("int"), F.lit(0).alias("particle"), "pos"
    )
    types = v_traj(spark, sf).select(
        F.col("particle").cast("int").alias("traj_id"), F.lit(0).alias("particle"), (F.col("particle") % 9).alias("particle_type")
    ).distinct()
    FT.write_trajectories(tracks, path, "train", frames_per_chunk=32, particle_type=types)
    t = FT.read_trajectories(spark, path, "train")
    return t.select(
        "traj_id", "frame", F.col("pos")[0].alias("x0"), F.col("pos")[1].alias("x1"), "particle_type"
    )


@register(
    "tensor_store_roundtrip",
    with_views(
        """WITH least AS (
  SELECT traj_id, min(n) AS n FROM (SELECT traj_id, particle, count(*) AS n FROM v_traj GROUP BY ALL) GROUP BY traj_id)
SELECT traj_id, frame, particle, particle % 9 AS particle_type, CAST(pos[1] AS FLOAT)::DOUBLE AS x0, CAST(pos[2] AS FLOAT)::DOUBLE AS x1
FROM v_traj JOIN least USING (traj_id) WHERE frame < n""",
        "v_traj",
    ),
)
def q_tensor_store_roundtrip(spark, sf):
    """SC4 + SC5 + SC8: trajectories of many particles, up to the length of the
    shortest track, written to a committed store and read by byte ranges."""
    path = scratch_path(spark, "tensor-store")
    t = materialize(v_traj(spark, sf))
    lengths = t.groupBy("traj_id", "particle").agg(F.count(F.lit(1)).alias("n"))
    least = lengths.groupBy("traj_id").agg(F.min("n").alias("n"))
    dense = t.join(least, "traj_id").where("frame < n").withColumn("particle_type", F.col("particle") % 9)
    TS.write_store(dense, path, frames_per_chunk=64)
    return TS.read_store(spark, path).select(
        "traj_id", "frame", "particle", "particle_type", F.col("pos")[0].alias("x0"), F.col("pos")[1].alias("x1")
    )


@register("history_sink_roundtrip", with_views("SELECT run_id, step, round(loss, 9) AS loss FROM v_history", "v_history"))
def q_history_sink_roundtrip(spark, sf):
    """SC12: metric history appended in two commits, compacted, read back."""
    path = scratch_path(spark, "history")
    h = materialize(v_history(spark, sf))
    FS.append_history(h.where("step % 2 = 0"), path)
    FS.append_history(h.where("step % 2 = 1"), path)
    HS.compact(spark, path)
    return HS.read(spark, path).select("run_id", "step", F.round("loss", 9).alias("loss"))


@register(
    "history_sink_runs",
    with_views("SELECT run_id, step, round(loss, 9) AS loss FROM v_history WHERE run_id IN (1, 5, 17, 40)", "v_history"),
)
def q_history_sink_runs(spark, sf):
    """SC12: some runs of the sink; only their buckets are read."""
    path = scratch_path(spark, "history")
    FS.append_history(v_history(spark, sf), path)
    return HS.read(spark, path, runs=[1, 5, 17, 40]).select("run_id", "step", F.round("loss", 9).alias("loss"))


@register(
    "dataset_versions",
    """WITH v AS (
  SELECT 0::BIGINT AS version, count(*)::BIGINT AS n_rows, 'v0' AS aliases FROM documents
  UNION ALL SELECT 1, count(*), 'latest,v1' FROM documents WHERE lang <> 'es')
SELECT 'documents' AS name, 'raw_data' AS type, version, n_rows, aliases,
  (SELECT n_rows FROM v WHERE version = 1) AS n_latest FROM v""",
)
def q_dataset_versions(spark, sf):
    """SC11 + SC15: register the documents table twice (same digest: one
    version), then a changed copy (second version); resolve ``:latest``."""
    from tessera.sources.tables import table

    root = scratch_path(spark, "store")
    docs = table(spark, sf, "documents")
    ST.register_dataset(spark, docs, root, "documents", "raw_data")
    ST.register_dataset(spark, docs, root, "documents", "raw_data")
    ST.register_dataset(spark, docs.where(F.col("lang") != "es"), root, "documents", "raw_data")
    latest = ST.use_artifact(spark, root, "documents:latest")
    arts = ST.versions_with_aliases(ST.read_artifacts(spark, root))
    n_latest = latest.count()
    return arts.select(
        "name", "type", "version", "n_rows", F.array_join("aliases", ",").alias("aliases"),
        F.lit(n_latest).cast("bigint").alias("n_latest"),
    )


@register(
    "metric_document_json",
    f"""SELECT *, 'text_classifier_e0.json' AS artifact, 'evaluation' AS type, CAST(0 AS BIGINT) AS version FROM ({DOCUMENT_SQL})""",
)
def q_metric_document_json(spark, sf):
    """SC3 + SC14 + SC2: the evaluation document saved under its model and run,
    logged as an ``evaluation`` artifact, resolved and read back in its order."""
    doc = materialize(evaluation_of(spark, sf))
    root = scratch_path(spark, "eval")
    name = "text_classifier_e0.json"
    saved = FS.save_document(doc, f"{root}/text_classifier/r0", name)
    ST.log_file(spark, root, name, "evaluation", saved)
    art = ST.read_artifacts(spark, root).where("type = 'evaluation'").first()
    back = FS.read_json_documents(spark, art["path"], doc.schema)
    return rounded_rows(back).withColumns(
        {"artifact": F.lit(art["name"]), "type": F.lit(art["type"]), "version": F.lit(art["version"])}
    )
