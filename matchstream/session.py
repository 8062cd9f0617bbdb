"""Session factory and the shared work folder.

Batch settings favour the optimiser: AQE on (runtime coalescing and skew
split), session time zone pinned to UTC so event-time windows do not depend on
the host.  Streaming state can use RocksDB so large keyed state spills to disk
instead of the JVM heap.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture for error messages costs a JVM round trip per
    # column function while plans are built; the engine builds many of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    master: str | None = None,
    app_name: str = "matchstream",
    shuffle_partitions: int | None = None,
    rocksdb_state: bool = False,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is left to the launcher when None, as on a cluster.  The
    checkpoint folder is only set here when neither the caller nor the
    cluster configured one (tests, local runs).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        work_root(spark)
    return spark


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Starting sizes for a large cluster (pass as ``extra_conf``).

    Shuffle partitions start high (AQE coalesces them at run time toward
    ``advisoryPartitionSizeInBytes``) so a 100 TB stage is never squeezed
    into too few reducers; scan splits stay at 256 MB.  Streaming state goes
    to RocksDB with changelog checkpointing so large keyed state neither
    lives on the JVM heap nor re-uploads full snapshots every batch.
    """
    partitions = max(4 * total_cores, 200)
    if input_bytes:
        partitions = max(partitions, int(input_bytes // (256 * 1024 * 1024)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def _local_root(master: str) -> str:
    """A temporary folder for local runs; on a cluster a shared one must be configured."""
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="matchstream-work-")


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint
    directory); only when neither is set — local runs and tests — a folder is
    created and registered so later calls agree.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context, only the session conf
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            root = _local_root(spark.conf.get("spark.master", ""))
            try:
                spark.conf.set("spark.checkpoint.dir", root)
            except Exception:  # core conf not settable: keep it for this process
                pass
        return root
    root = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    if not root:
        root = _local_root(sc.master)
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared work folder."""
    return os.path.join(work_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
