"""Session construction and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tessera job relies on.  ANSI stays on (Spark 4 default); the
# operators use try_* functions where raw text may be malformed.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints (rank_within, product_metrics) are deleted once the
    # DataFrame that owns them is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return a session configured for tessera.

    On a cluster call it without ``master`` and let spark-submit decide; the
    shuffle width then stays whatever the cluster configured (AQE coalesces).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``.  Where it is unset, a session
    in one JVM (``local`` master, tests) gets a temporary folder that is
    deleted at exit; a cluster raises, since its executors share no local
    folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not re.match(r"local(\[[^]]*\])?$", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def _scratch_of(spark: SparkSession) -> str:
    return os.path.join(scratch_root(spark), "tessera", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch folder."""
    return os.path.join(_scratch_of(spark), f"{name}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to :func:`scratch_path` (call it once
    no DataFrame that reads from there is needed)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_of(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
