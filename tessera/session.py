"""Session construction for local runs and the shared scratch location.

On a cluster the session is built by the platform; the library only reads
``spark.checkpoint.dir`` from it. ``local_session`` is for tests and benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tessera", checkpoint_dir: str | None = None,
                  event_log_dir: str | None = None, extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be:
    AQE on (runtime coalescing, skew-join splitting), UTC, no UI."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints of derived tables are removed once no DataFrame uses them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    directory). Only when neither is set and the master is local (a test or
    bench session) a private folder is created and registered; on a cluster
    an unset checkpoint directory is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for the cluster")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch folder."""
    base = scratch_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def scale_settings(input_bytes: int, partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Session settings for a cluster job reading about ``input_bytes``.

    Shuffles start with enough partitions for ~``partition_bytes`` each at the
    input size (AQE then coalesces small ones and splits skewed ones), scan
    splits are ``partition_bytes``, and broadcasts stay under Spark's own
    size-checked threshold. Apply with ``SparkSession.builder.config(map=...)``
    or ``spark.conf.set`` for the SQL keys."""
    parts = max(200, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
