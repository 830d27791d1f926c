"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Runtime settings the operators rely on. All of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split hot partition is worth an extra shuffle further down
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows that lie by one key of a join stay there, only the other side is dealt out
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # the union of several inputs waits for the slowest of them
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def tune(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and hand-over tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``; without one it is an error. Only where all of Spark is one
    process, as in a local test, a fresh temporary folder is used (and remembered for the session).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
