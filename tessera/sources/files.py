"""File sources and sinks: CSV tables, JSON documents, directory listings
(SC1, SC2, SC3, SC10, SC12, SC14)."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.core import take_sample
from tessera.sources import history_store
from tessera.sources.store import path_exists

LABELLED_SCHEMA = "id long, created_on timestamp, title string, description string, tag string"

# NULL gets an explicit marker so that empty strings survive a round trip
# (with the default marker "" both read back as NULL).
CSV_OPTS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "nullValue": "\\N"}


def read_csv(spark: SparkSession, path: str, schema: str = LABELLED_SCHEMA, *, num_samples: int | None = None,
             key: str = "id", seed: int = 1234) -> DataFrame:
    """SC1: header CSV with an explicit schema (no inference pass); optional
    reproducible first-``num_samples`` of the seeded shuffle (0/None = all)."""
    df = spark.read.schema(schema).options(**CSV_OPTS).csv(path)
    return take_sample(df, key, num_samples, seed) if num_samples else df


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; surrounding whitespace is kept (Spark's writer trims it by default)."""
    df.write.mode("overwrite").options(
        **CSV_OPTS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """SC2: whole-file JSON documents (one row per file)."""
    r = spark.read.option("multiLine", "true")
    if schema:
        r = r.schema(schema)
    return r.json(path)


def save_document(df: DataFrame, folder: str, filename: str, *, sort_keys: bool = False) -> str:
    """SC3 / SC14: the one row of ``df`` as an indented JSON document of the
    given name; the path written. ``sort_keys`` orders the keys of all levels.

    A document is small (metrics of a label set), so the driver writes it. Any
    other number of rows is an error; a file of that name is replaced."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).take(2)
    if len(rows) != 1:
        raise ValueError("a document is exactly one row")
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{filename}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target, True)
    out.write(bytearray(json.dumps(json.loads(rows[0][0]), indent=2, sort_keys=sort_keys).encode()))
    out.close()
    return path


def read_config(spark: SparkSession, config: str) -> dict:
    """ST-16: a configuration given as JSON text, or else as the path of a JSON
    file on any file system Spark reads. Anything else is a ValueError."""
    if not isinstance(config, str):
        raise ValueError(f"a configuration is JSON text or a path, not {type(config).__name__}")
    text = config
    if not config.lstrip().startswith("{"):
        if not config.strip() or not path_exists(spark, config):
            raise ValueError(f"neither JSON text nor a file: {config!r}")
        text = spark.read.text(config, wholetext=True).first()[0]
    try:
        found = json.loads(text)
    except ValueError as e:
        raise ValueError(f"not JSON: {config!r}") from e
    if not isinstance(found, dict):
        raise ValueError("a configuration is a JSON object")
    return found


def list_files(spark: SparkSession, dir_path: str) -> DataFrame:
    """SC10: files one level deep with size and modification time. The
    ``content`` column is never selected, so no file body is read."""
    if not os.path.isdir(dir_path):
        raise ValueError(f"not a folder: {dir_path}")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(dir_path)
    return df.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        "length",
        "modificationTime",
    )


def append_history(history: DataFrame, path: str, run: str = "run_id", step: str = "step") -> int:
    """SC12: append metric-history rows to the bucketed, committed sink of
    :mod:`tessera.sources.history_store`; the version of the commit."""
    return history_store.append(history, path, run=run, step=step)
