"""Spark session settings and the shared work folder.

Every job in this package is written against a plain ``SparkSession``;
nothing here is needed on a cluster that already has one.  ``get_session``
is the local/test entry (UTC session zone, AQE on, UI off).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings the jobs rely on.  ANSI stays at the Spark 4 default (on); the
# jobs use try_cast / get() wherever bad text may occur.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what has been measured: no plan-time broadcast from
    # estimated statistics; AQE may still turn a join into a broadcast from
    # the measured size of a finished shuffle, and sized_broadcast() measures
    # explicitly.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Inline a struct built in one projection into the field extractions of
    # the next, so only the extracted leaves are computed (nested events built
    # in-plan would otherwise be materialised whole for every row).
    "spark.sql.optimizer.collapseProjectAlwaysInline": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "orderloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the settings above to an existing session (driver-provided)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException as e:  # static on a running session: leave as is
            if "CANNOT_MODIFY" not in str(e.getCondition()):
                raise


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Read ``spark.checkpoint.dir`` (or the context's checkpoint dir) from the
    session.  Only when neither is set and the master is local -- tests --
    create one and register it, so later ``checkpoint()`` calls use it too;
    on a cluster a machine's own folder would lose what others write.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="orderloom-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/orderloom/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Partition sizing for a cluster run, from the bytes read and the cores.

    Scan splits and shuffle partitions target ``target_partition_bytes`` so a
    task's data fits executor memory with room to spill; the initial shuffle
    partition count is high (at least 2 waves of the cluster) and AQE merges
    partitions back to the advisory size at run time and splits skewed ones
    (capped at 50k: map-status metadata grows with maps x reducers; beyond
    50k x the target, that is 12.5 TB at the default, partitions grow and spill).
    Streaming state goes to RocksDB (off-heap, spills to local disk).
    """
    by_size = max(1, input_bytes // target_partition_bytes)
    initial = int(min(max(by_size, 2 * total_cores), 50_000))
    mb = target_partition_bytes // (1024 ** 2)
    return {
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def configure_for_scale(spark: SparkSession, input_bytes: int, total_cores: int) -> dict[str, str]:
    """Apply ``scale_settings`` to a running session; returns what was set."""
    apply_defaults(spark)
    conf = scale_settings(input_bytes, total_cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
