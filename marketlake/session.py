"""Session construction and shared-storage helpers.

Library code never pins shuffle partitions or memory: the cluster owns the
session. ``build_session`` is for scripts and tests only and sets values only
where they are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied by build_session when the key is not already set.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "marketlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session for scripts/tests.

    A new session gets the defaults; an already running session is reused
    and only keys it does not set yet are filled in (runtime SQL settings;
    static ones cannot change on a running session and are left alone).
    """
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    active = SparkSession.getActiveSession()
    if active is not None:
        for key, value in conf.items():
            if active.conf.get(key, None) is None:
                try:
                    active.conf.set(key, value)
                except Exception:  # noqa: BLE001 - static config of a running session
                    pass
        checkpoint_root(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path
    set by the cluster). Only when it is unset -- local runs and tests -- a
    private scratch folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - API absent on some builds
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def cluster_conf(
    input_bytes: int,
    total_cores: int,
    shuffled_fraction: float = 0.4,
    shuffle_partition_bytes: int = 512 * 1024 * 1024,
    scan_split_bytes: int = 1024 * 1024 * 1024,
) -> dict[str, str]:
    """Starting settings for a cluster run over ``input_bytes`` of Parquet.

    Scan splits of ``scan_split_bytes`` keep the map-task count (and shuffle
    metadata) bounded -- 100 TB -> ~100k tasks. Shuffle partitions are sized
    from the bytes that actually move (the dedup shuffles carry the pruned
    columns only, ``shuffled_fraction`` of the input) at
    ``shuffle_partition_bytes`` each, never fewer than 2x the cores; AQE then
    coalesces small ones and splits skewed join partitions. Pass the result
    to ``spark-submit --conf`` or ``SparkSession.builder.config``.
    """
    import math

    shuffled = input_bytes * shuffled_fraction
    partitions = max(2 * total_cores, math.ceil(shuffled / shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
