"""Versioned dataset / artifact store on shared storage (SC11, SC13, SC15).

Each artifact name has a commit log whose entry ``n`` is version ``n``:
``(name, type, version, created_at, path, digest, n_rows)``. Contents lie in
folders of their own, written before the entry that names them. Two writers at
once give two versions, and readers see whole versions only. A new dataset
version is made only when the content digest changes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.commit_log import CommitLog

ARTIFACT_SCHEMA = (
    "name string, type string, version long, created_at timestamp, path string, "
    "digest string, n_rows long"
)


def content_digest(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a table: ``bit_xor`` of a 64-bit row hash,
    plus the sum of the hashes modulo 2^31 (XOR alone cancels duplicate
    pairs) and the row count. One partial aggregate, one output row."""
    # xxhash64 skips NULLs, so each column also contributes whether it is one
    h = F.xxhash64(*[x for c in df.columns for x in (F.col(c), F.col(c).isNull())])
    return df.agg(
        F.bit_xor(h).alias("x"),
        F.sum(F.pmod(h, F.lit(2147483648))).alias("s"),
        F.count(F.lit(1)).alias("n"),
    ).select(
        F.concat_ws(":", F.hex(F.col("x")), F.col("s").cast("string"), F.col("n").cast("string")).alias("digest"),
        F.col("n").alias("n_rows"),
    )


def _log_root(root: str) -> str:
    return f"{root.rstrip('/')}/_log"


def artifact_log(spark: SparkSession, root: str, name: str) -> CommitLog:
    return CommitLog(spark, f"{_log_root(root)}/{quote(name, safe='')}")


def _content_path(root: str, name: str) -> str:
    """A folder that no other writer uses."""
    return f"{root.rstrip('/')}/{quote(name, safe='')}/{uuid.uuid4().hex}"


def _entry(name: str, kind: str, version: int, path: str, digest: str, n_rows: int) -> dict:
    at = dt.datetime.now(dt.timezone.utc).isoformat()
    return {"name": name, "type": kind, "version": version, "created_at": at, "path": path, "digest": digest, "n_rows": n_rows}


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """The artifact table of ``root`` (empty before the first registration);
    ``root`` may be on any file system that Spark can reach."""
    if not path_exists(spark, _log_root(root)):
        return spark.createDataFrame([], ARTIFACT_SCHEMA)
    return spark.read.schema(ARTIFACT_SCHEMA).json(f"{_log_root(root)}/*/*.json")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system its URI names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def register_dataset(spark: SparkSession, df: DataFrame, root: str, name: str, data_type: str) -> tuple[bool, str]:
    """SC11: store ``df`` as dataset ``name``; bump the version only when the
    content digest differs from the latest version. Returns
    ``(True, "name:latest")`` or ``(False, "")`` when writing fails.

    A writer that finds its version number taken looks at the version that took
    it: equal content makes no further version, other content the next one."""
    if not name:
        raise ValueError("dataset name is empty")
    digest_row = content_digest(df).first()  # one row
    path, written = _content_path(root, name), False

    def decide(version: int, last: dict | None) -> dict | None:
        nonlocal written
        if last is not None and last["digest"] == digest_row["digest"]:
            return None
        if not written:
            df.write.parquet(path)
            written = True
        return _entry(name, data_type, version, path, digest_row["digest"], digest_row["n_rows"])

    try:
        artifact_log(spark, root, name).append(decide)
    except Exception:  # noqa: BLE001 - failure is reported as (False, "")
        return False, ""
    return True, f"{name}:latest"


def versions_with_aliases(arts: DataFrame) -> DataFrame:
    """``aliases``: ``v<k>`` for every version, plus ``latest`` on the newest."""
    newest = arts.groupBy("name").agg(F.max("version").alias("__max"))
    return arts.join(newest, "name").withColumn(
        "aliases",
        F.when(F.col("version") == F.col("__max"), F.array(F.lit("latest"), F.concat(F.lit("v"), F.col("version").cast("string"))))
        .otherwise(F.array(F.concat(F.lit("v"), F.col("version").cast("string")))),
    ).drop("__max")


def use_artifact(spark: SparkSession, root: str, ref: str) -> DataFrame:
    """SC15: resolve ``name:alias`` and read the stored content."""
    if ref.count(":") != 1:
        raise ValueError(f"artifact reference must be name:alias, got {ref!r}")
    name, alias = ref.split(":")
    hit = (
        versions_with_aliases(read_artifacts(spark, root))
        .where((F.col("name") == name) & F.array_contains("aliases", alias))
        .select("path")
        .collect()
    )
    if not hit:
        raise KeyError(ref)
    return spark.read.parquet(hit[0]["path"])


def log_model(spark: SparkSession, model, root: str, name: str) -> str:
    """SC13: save an MLlib model as a new ``model`` artifact version."""
    path = _content_path(root, name)
    model.write().save(path)
    artifact_log(spark, root, name).append(lambda version, last: _entry(name, "model", version, path, "", 0))
    return path


def log_file(spark: SparkSession, root: str, name: str, kind: str, path: str) -> int:
    """SC14: a file that is there already as a new version of artifact ``name``."""
    return artifact_log(spark, root, name).append(lambda version, last: _entry(name, kind, version, path, "", 0))
