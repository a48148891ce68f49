"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins and coalesces/splits shuffle
# partitions at run time; skew-join splitting handles a hot join key; UTC pins
# window boundaries and epoch conversions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of the skew-safe scans are deleted once their DataFrames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app: str = "streamlens", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    ``master`` is only used when no session exists (tests, bench); on a cluster the
    launcher decides it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The cluster's setting always wins. Only in a local session (tests) without it a fresh scratch folder is
    registered; elsewhere the missing setting is an error, as a machine-local folder would be lost with
    its node.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="streamlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-query streaming checkpoint location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)
