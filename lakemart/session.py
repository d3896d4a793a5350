"""Session creation for tests and benchmarks, and shared scratch paths.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A checkpoint directory is set here only when
the session has none (local tests), never replacing a configured one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: str | None = None
_SCRATCH: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lakemart", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Small local shuffles: keep partitions (and cores) for CPU-heavy sorts;
        # on a cluster the platform's advisory partition size applies.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster a session without one is an error: a machine-local folder would
    hold a part of each table on each machine. Only a local master (tests, one
    machine) gets a fresh temporary folder.
    """
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        root = _LOCAL_ROOT
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below this application's part of the shared checkpoint
    folder. That part goes when the driver's JVM ends."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/lakemart-scratch/{spark.sparkContext.applicationId}"
    if folder not in _SCRATCH:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _SCRATCH.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def env_int(name: str, default: int) -> int:
    value = os.environ.get(name)
    return int(value) if value else default
