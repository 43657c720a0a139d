"""Binding views: the reference's input shapes expressed over the given tables.

Each ``v_*`` builds a lazy DataFrame; ``SQL_VIEWS`` holds the same definitions
in DuckDB SQL for the oracle. Keep both sides in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import one_hot_decode, to_double_array
from tessera.operators.core import bucketed_rank
from tessera.sources.tables import table

# Fixed fixture parameters.
LOGIT_CLASSES = 64  # all components of an embedding
LOGIT_FALLBACK = 9
LOGIT_THRESHOLD = 0.2
TRAJ_WINDOW = 7
POINT_RADIUS = 0.05
POINT_BOUNDS = [[-0.4, 0.4], [-0.4, 0.4]]
MESH_TYPES = 9
SLICE_TAG = "en"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents table in at least as many partitions as there are cores.

    Per-row text work (regex cleaning, word counts) is CPU-bound, while a
    parquet file is scanned one row group per task: a small table written with
    few row groups would put all documents in a handful of tasks. Such a table
    is dealt anew; one whose scan has a partition for every core is read as it
    lies, so no large corpus is shuffled for balance."""
    docs = table(spark, sf, "documents")
    few = docs.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    return docs.repartition("doc_id") if few else docs


def v_text(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    """``spread=True`` for queries that run per-document regex work right
    after the scan (see :func:`documents`); cheap queries skip the shuffle."""
    d = documents(spark, sf) if spread else table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.lit(None).cast("timestamp").alias("created_on"),
        F.substring("text", 1, 40).alias("title"),
        F.expr("substr(text, 41)").alias("description"),
        F.col("lang").alias("tag"),
        F.when(F.col("n_chars") % 7 == 0, F.lit("en")).otherwise(F.col("lang")).alias("y_pred"),
    )


def v_logits(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").alias("key"),
        to_double_array(F.col("embedding")).alias("z"),
        F.col("label").cast("bigint").alias("target"),
    )


EVENT_BUCKET = "day"  # coarser buckets keep the count table small; use "hour" for very dense keys


#: Rows of a user's track up to which :func:`v_traj` ranks it in one task.
WHOLE_TRACK = 100_000


def _event_order(ev: DataFrame, group: str = "user_id", unit: str = EVENT_BUCKET, whole: int | None = None) -> DataFrame:
    """0-based position of each event in its group by ``(ts, event_id)``.

    Bucketed by ``unit`` of ``ts``, so one very active user is ranked in many
    tasks while the (user, bucket) count table stays far smaller than the
    events. With ``whole`` this holds for users of more rows only."""
    ranked = bucketed_rank(
        ev,
        order=[F.col("ts"), F.col("event_id")],
        bucket=F.date_trunc(unit, F.col("ts")),
        group_cols=[group],
        rank_col="__pos",
        whole=whole,
    )
    return ranked.withColumn("__pos", F.col("__pos") - 1)


def v_traj(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    out = _event_order(ev, whole=WHOLE_TRACK).select(
        (F.col("user_id") % 10).alias("traj_id"),
        F.col("user_id").alias("particle"),
        F.col("__pos").alias("frame"),
        F.array("value", "k").alias("pos"),
        F.col("k").alias("context"),
    )
    return out


def v_points(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("label").cast("bigint").alias("sample"),
        F.col("vec_id").alias("node"),
        to_double_array(F.slice("embedding", 1, 2)).alias("pos"),
        (F.col("vec_id") % 9).alias("particle_type"),
    )


DENSE_RADIUS = 0.002


def v_dense_points(spark: SparkSession, sf: str) -> DataFrame:
    """Two point clouds that crowd at the origin: the cubes of two components."""
    e = to_double_array(F.slice("embedding", 1, 2))
    cubes = F.transform(e, lambda x: x * x * x)
    return table(spark, sf, "embeddings").select(
        (F.col("label") % 2).cast("bigint").alias("sample"), F.col("vec_id").alias("node"), cubes.alias("pos")
    )


def v_mesh(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    onehot = to_double_array(F.slice("embedding", 3, MESH_TYPES))
    return e.select(
        F.col("label").cast("bigint").alias("sample"),
        F.col("vec_id").alias("node"),
        to_double_array(F.slice("embedding", 1, 2)).alias("velocity"),
        onehot.alias("onehot"),
        one_hot_decode(to_double_array(F.col("embedding")), 3, MESH_TYPES).alias("node_type"),
        to_double_array(F.slice("embedding", 12, 2)).alias("y"),
        to_double_array(F.slice("embedding", 14, 2)).alias("pred"),
        F.floor(F.col("label") / 2).cast("bigint").alias("batch"),
    )


def v_graph_nodes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(source nodes = parts, target nodes = suppliers)."""
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("node"),
        F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("x"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("node"),
        F.array(F.col("s_acctbal").cast("double")).alias("x"),
    )
    return p, s


def v_graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_partkey").alias("src"),
        F.col("l_suppkey").alias("dst"),
        F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")).alias("attr"),
    )


def v_hub_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from parts to the nations of their suppliers: few targets, all of them hubs."""
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("dst"))
    return li.join(s, on="l_suppkey").select(
        F.col("l_partkey").alias("src"), "dst", F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")).alias("attr")
    )


def v_hub_nodes(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("node"), F.array(F.col("n_regionkey").cast("double")).alias("x"))


def v_runs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("run_group"),
        F.col("o_orderstatus").alias("project"),
        F.col("o_totalprice").alias("val_loss"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderkey") % 11 == 0, F.array(F.lit("delete")))
        .otherwise(F.array().cast("array<string>"))
        .alias("tags"),
    )


ARTIFACT_TIEBREAK = [
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_linestatus",
]


def v_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("checkpoint_TorchTrainer_"), F.col("l_orderkey").cast("string")).alias("name"),
        F.col("l_returnflag").alias("type"),
        F.col("l_shipdate").alias("created_at"),
        *ARTIFACT_TIEBREAK,
    )


def v_history(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "value", "props")
    k = F.get_json_object("props", "$.k").cast("double")
    return _event_order(ev).select(
        F.col("user_id").alias("run_id"),
        F.date_trunc("day", F.col("ts")).alias("epoch"),
        F.col("__pos").alias("step"),
        F.col("value").cast("double").alias("loss"),
        (F.lit(1.0) / (F.lit(1.0) + k)).alias("lr"),
        F.col("ts").alias("logged_at"),
    )


# DuckDB definitions of the same views (CTE bodies), used by oracle SQL.
SQL_VIEWS = {
    "v_text": """SELECT doc_id AS id, CAST(NULL AS TIMESTAMP) AS created_on,
        substr(text, 1, 40) AS title, substr(text, 41) AS description, lang AS tag,
        CASE WHEN n_chars % 7 = 0 THEN 'en' ELSE lang END AS y_pred FROM documents""",
    "v_logits": """SELECT vec_id AS key, list_transform(embedding, lambda x: x::DOUBLE) AS z,
        CAST(label AS BIGINT) AS target FROM embeddings""",
    "v_traj": """SELECT user_id % 10 AS traj_id, user_id AS particle,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
        [value::DOUBLE, json_extract_string(props, '$.k')::DOUBLE] AS pos,
        json_extract_string(props, '$.k')::DOUBLE AS context FROM events""",
    "v_points": """SELECT CAST(label AS BIGINT) AS sample, vec_id AS node,
        list_transform(embedding[1:2], lambda x: x::DOUBLE) AS pos, vec_id % 9 AS particle_type
        FROM embeddings""",
    "v_dense_points": """SELECT CAST(label % 2 AS BIGINT) AS sample, vec_id AS node,
        list_transform(embedding[1:2], lambda x: x::DOUBLE * x::DOUBLE * x::DOUBLE) AS pos FROM embeddings""",
    "v_mesh": """SELECT CAST(label AS BIGINT) AS sample, vec_id AS node,
        list_transform(embedding[1:2], lambda x: x::DOUBLE) AS velocity,
        list_transform(embedding[3:11], lambda x: x::DOUBLE) AS onehot,
        CAST(list_position(list_transform(embedding[3:11], lambda x: x::DOUBLE),
             list_max(list_transform(embedding[3:11], lambda x: x::DOUBLE))) - 1 AS BIGINT) AS node_type,
        list_transform(embedding[12:13], lambda x: x::DOUBLE) AS y,
        list_transform(embedding[14:15], lambda x: x::DOUBLE) AS pred,
        CAST(floor(label / 2) AS BIGINT) AS batch FROM embeddings""",
    "v_src_nodes": """SELECT p_partkey AS node, [p_size::DOUBLE, p_retailprice::DOUBLE] AS x FROM part""",
    "v_dst_nodes": """SELECT s_suppkey AS node, [s_acctbal::DOUBLE] AS x FROM supplier""",
    "v_edges": """SELECT l_partkey AS src, l_suppkey AS dst,
        [l_quantity::DOUBLE, l_discount::DOUBLE] AS attr FROM lineitem""",
    "v_hub_edges": """SELECT l_partkey AS src, CAST(s_nationkey AS BIGINT) AS dst,
        [l_quantity::DOUBLE, l_discount::DOUBLE] AS attr FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "v_hub_nodes": """SELECT CAST(n_nationkey AS BIGINT) AS node, [n_regionkey::DOUBLE] AS x FROM nation""",
    "v_runs": """SELECT o_orderkey AS run_id, o_orderpriority AS run_group, o_orderstatus AS project,
        o_totalprice AS val_loss, o_orderdate AS created_at,
        CASE WHEN o_orderkey % 11 = 0 THEN ['delete'] ELSE []::VARCHAR[] END AS tags FROM orders""",
    "v_artifacts": """SELECT l_orderkey AS run_id, 'checkpoint_TorchTrainer_' || l_orderkey AS name,
        l_returnflag AS type, l_shipdate AS created_at, l_partkey, l_suppkey, l_linenumber,
        l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus FROM lineitem""",
    "v_history": """SELECT user_id AS run_id, date_trunc('day', ts) AS epoch,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
        value::DOUBLE AS loss, 1.0::DOUBLE / (1.0::DOUBLE + json_extract_string(props, '$.k')::DOUBLE) AS lr,
        ts AS logged_at FROM events""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with a WITH clause defining the named binding views."""
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
