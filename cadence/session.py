"""Session settings and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide one-pass reports (a Pearson matrix, a profile of every column) carry
    # more than 100 aggregation-buffer fields; keep them in whole-stage codegen
    # (Spark still falls back by itself when a method would grow too large)
    "spark.sql.codegen.maxFields": "1000",
    # remove reliable checkpoint files once their RDDs are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 1024) -> dict[str, str]:
    """Partition sizing for a given input size and cluster.

    Scans split at 256 MB. ``input_bytes`` is what a query shuffles after projection (the
    input's size is the safe bound): shuffles start with partitions of about
    ``target_partition_mb`` (at least 2 per core), and AQE merges small ones and splits
    skewed ones at run time. At 100 TB on 1000 executors x 8 cores that is ~100,000
    partitions of ~1 GB; maps times reduces stay countable for the driver, and sorts and
    aggregations of a partition spill rather than exceed executor memory.
    """
    parts = max(2 * total_cores, -(-input_bytes // (target_partition_mb * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_mb * MB),
    }


def get_session(master: str | None = None, partitions: int = 8, app: str = "cadence",
                input_bytes: int | None = None, total_cores: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with UTC time, ANSI and AQE on and the UI off.

    With ``input_bytes`` and ``total_cores`` the partition sizes come from
    ``sizing_conf``; otherwise ``partitions`` shuffle partitions (local runs)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if input_bytes and total_cores:
        for k, v in sizing_conf(input_bytes, total_cores).items():
            builder = builder.config(k, v)
    else:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("CADENCE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (tests, a laptop) do we
    create our own folder; on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder (HDFS, S3, ...) "
                "so checkpoints and scratch tables survive executor loss."
            )
        conf = tempfile.mkdtemp(prefix="cadence-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
