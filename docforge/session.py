"""Spark session and shared-storage helpers.

The library never invents storage on a cluster: generations, spools and
checkpoints live under the folder the cluster names in
``spark.checkpoint.dir``. Only a local-mode session (tests, bench) gets a
scratch folder of its own when that setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Partitions that text is dealt over before it is analysed; unset (the default): those of the scan. Set it where the
#: files have too few row groups for the cores, as single-file tables in local runs have.
PARTITIONS_KEY = "spark.docforge.analysis.partitions"


def build_session(master: str | None = None, app: str = "docforge", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session tuned for the document pipeline (AQE on, UTC, no UI)."""
    master = master or os.environ.get("DOCFORGE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOCFORGE_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master.startswith("local") and "spark.sql.warehouse.dir" not in (extra or {}):
        # local runs only: keep catalog files out of the working directory
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="docforge-warehouse-"))
    if master.startswith("local"):
        builder = builder.config(PARTITIONS_KEY, str(shuffle_partitions or 8))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for durable state: ``spark.checkpoint.dir``.

    Read from the session. When it is unset and the session runs in local
    mode (tests, bench) a fresh scratch folder is created and registered; on
    a cluster an unset value is an error, because a machine-local folder is
    not visible to other executors and does not survive their loss.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="docforge-")
    spark.conf.set(_CHECKPOINT_KEY, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the shared root."""
    return shared_root(spark)


def spread(df):
    """``df`` dealt over the number of partitions the session sets for text analysis, if it sets one."""
    partitions = df.sparkSession.conf.get(PARTITIONS_KEY, None)
    return df.repartition(int(partitions)) if partitions else df


@lru_cache(maxsize=8)
def _scratch(application: str, root: str) -> str:
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    path = f"{root}/scratch-{application}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for what only this application needs; removed when its driver ends."""
    return f"{_scratch(spark.sparkContext.applicationId, shared_root(spark))}/{name}-{uuid.uuid4().hex[:12]}"
