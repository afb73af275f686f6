"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "liftkit") -> SparkSession:
    """Return the active session, or build a local one for tests and benches.

    On a cluster the session already exists and its settings win; this only fills in what
    is unset. AQE stays on so shuffle partitions coalesce and skewed joins split at runtime.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="liftkit-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (a shared folder). Only a local-mode
    session without one (tests, benches) gets a scratch folder; on a cluster a missing
    setting is an error, since a machine-local folder is not visible to other executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="liftkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def recommended_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 ** 2,
                     max_partitions: int = 65536) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    Scan splits of ``partition_bytes`` keep each task's input bounded. The initial shuffle
    partition count assumes shuffles carry at most the input size (column pruning and
    partial aggregation make them far smaller), is at least two waves of cores, and is capped
    at ``max_partitions`` (map-output metadata grows with maps x reducers); AQE then coalesces
    toward ``partition_bytes``. Skew handling splits any partition five times the median
    and over 512 MB.
    """
    initial = min(max_partitions, max(2 * total_cores, int(input_bytes // partition_bytes) + 1))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def apply_conf(spark, conf: dict, override: bool = False) -> dict:
    """Set the given SQL settings on the session, keeping values the cluster already set
    unless ``override``. Returns what was applied."""
    applied = {}
    for k, v in conf.items():
        if override or spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            applied[k] = v
    return applied
