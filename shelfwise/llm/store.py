"""Shared-folder tables: lineage cuts that survive lost executors.

Intermediate tables go under ``spark.checkpoint.dir`` (read from the session);
a driver-local folder is set only where the cluster names none, as in tests.
"""

from __future__ import annotations

import gc
import re

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_path

#: As many bytes of texts as the helpers in ``text`` work on at once.
BATCH_BYTES = 2 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared checkpoint root and read it back."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files behind a table that ``cut`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if not re.search(r"/llm/[a-z0-9_]+/[0-9a-f]{32}$", folder):
            raise ValueError(f"not a folder of this package: {folder}")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch for Python holds ``BATCH_BYTES`` or one row: at 10,000 whole texts, both sides of
    each task keep tens of MB, beyond the executor's heap."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(size)
    if not re.fullmatch(r"[0-9]+b?", now) or not 0 < int(now.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def fan_out(spark: SparkSession) -> int:
    """Buckets for a hash deal: the session's shuffle partitions, which grow with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps: it does so once their plans are collected on the driver."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
