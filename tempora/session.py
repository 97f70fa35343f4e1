"""Session helpers.

Nothing here hard-codes cluster sizing: on a cluster the submitter owns
``spark.sql.shuffle.partitions``, executor memory and ``spark.checkpoint.dir``.
``get_session`` only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the engine relies on; applied only when the submitter left them unset.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Streaming state per entity key can be large: keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
# Only for sessions this helper creates itself (local runs, tests, bench): no web UI.
_LOCAL_STATIC = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a local disk lists folders faster than a job does
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1024",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tempora", extra: dict | None = None) -> SparkSession:
    """Get (or create) the session; fill in engine defaults the submitter left unset.

    With ``master`` (local runs) the session is built here; without it the
    cluster's submitted configuration is used as is and only unset SQL
    defaults are added at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        for k, v in _LOCAL_STATIC.items():
            builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    chosen = spark.conf.getAll  # submitted, or set by the caller at run time
    for k, v in _SQL_DEFAULTS.items():
        if k not in chosen:
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage (unset there is an
    error). Only in local mode, when it is unset, a fresh local folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: "
                           "snapshots and scratch tables are written there")
    local = tempfile.mkdtemp(prefix="tempora-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder (with its scheme, if it has one)."""
    return os.path.join(ensure_checkpoint_dir(spark), "tempora", f"{name}-{uuid.uuid4().hex[:12]}")
