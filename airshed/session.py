"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package expects. Times in the warehouse are naive local or UTC wall-clock values, so the
# session zone is pinned to UTC; AQE re-plans joins and partition counts from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


# Cluster profile for ~100 TB of input on ~1000 executors. Input splits and shuffle partitions target ~256 MB so a
# task's working set fits executor memory with room to spill; AQE coalesces small shuffle partitions and splits
# skewed ones (a partition 5× the median and above 512 MB is split); broadcasts stay below 64 MB per side.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * TARGET_PARTITION_BYTES),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES,
                           minimum: int = 200) -> int:
    """Shuffle partitions for an expected shuffle volume (e.g. 20 TB → 81,920): AQE then merges the small ones."""
    return max(minimum, -(-shuffle_bytes // target_bytes))


def build_session(master: str | None = None, app_name: str = "airshed", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, cluster: bool = False,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied (``cluster`` adds :data:`CLUSTER_CONF`).

    ``checkpoint_dir`` is used where the cluster sets no ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    sc = spark.sparkContext
    if checkpoint_dir and not (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(checkpoint_dir)
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir_for(configured: str | None, master: str) -> str:
    """The checkpoint folder a session may use: the configured one, or a private one where everything is local."""
    if configured:
        return configured
    if is_local(master):
        return tempfile.mkdtemp(prefix="airshed-ckpt-")
    raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here; without it the job fails. A private
    directory is created only in local mode, which happens in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    configured = checkpoint_dir_for(configured, sc.master)
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for staged tables that must survive executor loss."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
