"""Session helpers: building a session for tests/bench and locating shared
folders (checkpoints, scratch output) from the session's own settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench.py.  Production jobs receive the
    cluster's session instead and never call this."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, *, executors: int = 1000, cores_per_executor: int = 8,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a job reading ``input_bytes`` on a large cluster.

    Shuffle partitions start from input size / target partition size (AQE
    then coalesces small ones and splits skewed ones), never fewer than two
    waves of the cluster's task slots; scans use large splits so a 100 TB
    input is ~400k tasks rather than millions; broadcasts stay small enough
    to ship to a thousand executors.  Launch the job with
    ``spark.cleaner.referenceTracking.cleanCheckpoints=true`` (a core setting),
    so that checkpoint files go when nothing refers to them any more.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
    }


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- Connect sessions raise here
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return str(master).startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session.

    Uses ``spark.checkpoint.dir`` (or a folder already set on the context).
    On a cluster it must be set, on storage that the driver and all executors
    share; only a local master, as in tests, gets a folder of its own here.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc is None or not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starloom-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh path for intermediate tables/files, next to the checkpoint
    folder so it lives on the same shared storage; Spark's writers make it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
