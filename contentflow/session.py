"""Session construction and cluster-level settings.

The library never hard-codes a machine-local scratch path: lineage is cut with
``DataFrame.checkpoint()`` into whatever shared folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent and the master is
``local`` (tests, local runs) do we point it at a fresh temporary directory; on a
cluster its absence is an error.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that every job relies on.  UTC is required because the inputs carry
# naive (NTZ) timestamps and all week/day truncation must be zone-independent.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (windows, sessions, dedupe keys) in RocksDB: off the JVM
    # heap and spilled to local disk, checkpointed to the checkpoint location.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "contentflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if the
    cluster did not configure ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext on the client)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # A folder of this machine serves only where driver and tasks are one process.
        master = sc.master if sc is not None else ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="contentflow-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured
