"""SparkSession construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a shuffle join into a broadcast join only after it has measured
    # the small side at runtime, so every broadcast is size-checked.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Return (or create) a session with the engine defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; locally pass
    ``local[N]``. ``shuffle_partitions`` should be sized so one shuffle
    partition stays in the 100-200 MB range at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder used to cut lineage (``checkpoint()`` / written tables).

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    local session gets a scratch folder; on a cluster it is an error, as
    executors do not see the driver's folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written
    intermediates (a POSIX path when the folder is a local / mounted one)."""
    import uuid

    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (data sources and pandas
    functions refer to its modules): zip it once into the shared checkpoint
    folder and ``addPyFile`` it."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    import uuid

    pkg = os.path.dirname(os.path.abspath(__file__))
    # Only the driver reads the archive; addPyFile ships it to the executors.
    ckpt = checkpoint_dir(spark)
    local = ckpt[len("file:"):] if ckpt.startswith("file:") else (ckpt if "://" not in ckpt else tempfile.mkdtemp())
    base = os.path.join(local, f"pkg-{uuid.uuid4().hex}")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="tessera")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable ``checkpoint()``
    written to the shared ``spark.checkpoint.dir`` (never a machine-local
    folder), so later uses scan the written rows instead of re-deriving them,
    and a lost executor does not force recomputation from the sources."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
