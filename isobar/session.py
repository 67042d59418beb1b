"""Session settings the library depends on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Day, month and year boundaries are UTC everywhere: ``window`` always aligns to
# the UTC epoch while ``date_trunc`` follows the session zone.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stored tables are opened by directory: one listing task for each of hundreds of hours costs more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    ``spark.sql.shuffle.partitions`` is left to the deployment: adaptive
    execution merges small shuffle partitions, so a cluster should set it high.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse to derive calendar keys in a session whose zone is not UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``.
    Only in local mode, and where that is unset, a temporary folder is made.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="isobar-", ignore_cleanup_errors=True)
        shared = _local_scratch.name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
