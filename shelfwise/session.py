"""Spark session helpers.

The library never hard-codes a machine-local scratch folder: lineage cuts and
streaming checkpoints go under ``spark.checkpoint.dir`` as configured by the
cluster. Only tests and the local bench set it, and only when it is unset.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app: str = "shelfwise",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session with AQE, skew-join splitting and the UI off.

    ``shuffle_partitions`` is an upper bound: AQE coalesces small partitions at
    runtime toward ``advisoryPartitionSizeInBytes`` and splits skewed ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executor_cores: int = 4, executor_memory_gb: int = 16) -> dict[str, str]:
    """Size shuffle and scan settings from the input volume (pass to ``build_session(extra=...)``).

    * scans split at 256 MB per task;
    * the initial shuffle fan-out targets ~200 MB per partition of input, capped
      at 100k, and AQE coalesces toward 256 MB advisory partitions at run time,
      so each task's sort/aggregate buffer stays far below its memory share
      (``executor_memory / executor_cores``) and spills gracefully;
    * skewed partitions above 1 GB (and 5x the median) are split by AQE;
    * runtime bloom filters may be built from up to 256 MB of the filtered side,
      so a date-filtered header prunes the un-dated detail before its shuffle.
    """
    parts = max(200, min(100_000, input_bytes // (200 * 1024 ** 2)))
    return {
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "1073741824",
        "spark.sql.files.maxRecordsPerFile": "20000000",
        "spark.executor.cores": str(executor_cores),
        "spark.executor.memory": f"{executor_memory_gb}g",
    }


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (memo keys must not outlive their session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no classic context
        return str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Raises when unset: a job must not silently fall back to a machine-local
    temporary folder that disappears with the executor.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; configure a shared (HDFS/S3/NFS) folder"
        )
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use ``spark.checkpoint.dir`` when the cluster names it; otherwise (tests, a
    local check) set the context's checkpoint folder once, to ``fallback``, or in
    a single-process session to a new temporary folder; a cluster must name one.

    ``spark.checkpoint.dir`` is a static setting, so only the context folder is
    set at runtime; ``checkpoint_root`` reads either.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.getCheckpointDir():
        import tempfile

        if not fallback and not re.fullmatch(r"local(\[[0-9*]+\])?", sc.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; executors share no machine-local folder")
        path = fallback or tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        os.makedirs(path, exist_ok=True)
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table directory exists (any Hadoop file system: HDFS, S3A, local)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint root (never reused)."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])
