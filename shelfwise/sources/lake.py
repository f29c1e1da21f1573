"""History lake: zstd parquet laid out by year and month, partition-pruned reads, retention.

Writes use a ``rebalance`` hint on the partition columns: AQE then splits a hot
month over several tasks and merges small ones, so one busy month never ends
up in a single writer task, and files stay near the advisory size.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAKE_PARTITIONS = ("yyyy", "mm")


def with_lake_partitions(df: DataFrame, date_col: str = "sell_date") -> DataFrame:
    return df.withColumn("yyyy", F.year(date_col)).withColumn("mm", F.month(date_col))


def lake_write(df: DataFrame, path: str, date_col: str = "sell_date", sort_by: list[str] | None = None,
               mode: str = "overwrite") -> None:
    """Write ``df`` under ``path/yyyy=/mm=`` as zstd parquet, sorted for row-group skipping."""
    w = with_lake_partitions(df, date_col).hint("rebalance", *LAKE_PARTITIONS)
    w = w.sortWithinPartitions(*LAKE_PARTITIONS, *(sort_by or [date_col]))
    (
        w.write.mode(mode)
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAKE_PARTITIONS)
        .parquet(path)
    )


def lake_write_snapshots(tables: dict[str, DataFrame], root: str, as_of: str) -> dict[str, str]:
    """Daily snapshots of inventory, products and shops next to the sales history:
    ``root/<name>/snapshot_date=<as_of>/`` (zstd), one dynamic partition per day."""
    paths = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        (
            df.withColumn("snapshot_date", F.lit(as_of).cast("date")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy("snapshot_date").parquet(path)
        )
        paths[name] = path
    return paths


def month_keys(start: str, end: str) -> list[tuple[int, int]]:
    s = dt.date.fromisoformat(start).replace(day=1)
    e = dt.date.fromisoformat(end).replace(day=1)
    out = []
    while s <= e:
        out.append((s.year, s.month))
        s = (s + dt.timedelta(days=32)).replace(day=1)
    return out


def lake_read(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Read the lake, pruning ``yyyy``/``mm`` partitions to the requested months."""
    df = spark.read.parquet(path)
    if start and end:
        ym = F.col("yyyy") * 100 + F.col("mm")
        lo = int(start[:4]) * 100 + int(start[5:7])
        hi = int(end[:4]) * 100 + int(end[5:7])
        df = df.where((F.col("yyyy") >= lo // 100) & (F.col("yyyy") <= hi // 100) & ym.between(lo, hi))
    return df


def drop_expired(spark: SparkSession, path: str, keep_from: str) -> list[str]:
    """Deletes the month folders before ``keep_from``'s month; their names. No kept row is read or written.

    ``retention`` is the way that leaves the old lake to its readers, at the price of copying what is kept.
    """
    cut = int(keep_from[:4]) * 100 + int(keep_from[5:7])
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for year in fs.listStatus(root):
        if not year.getPath().getName().startswith("yyyy="):
            continue
        for month in fs.listStatus(year.getPath()):
            y, m = (x.split("=")[1] for x in (year.getPath().getName(), month.getPath().getName()))
            if y.isdigit() and m.isdigit() and int(y) * 100 + int(m) < cut:
                fs.delete(month.getPath(), True)
                gone.append(f"yyyy={y}/mm={m}")
    spark.catalog.refreshByPath(path)
    return sorted(gone)


def retention(spark: SparkSession, path: str, keep_from: str, out_root: str) -> str:
    """Keep months on or after ``keep_from`` (partition filter) in a new snapshot directory.

    The old directory is left untouched for readers; the caller publishes the
    returned path. Only the kept partitions are read.
    """
    cut = int(keep_from[:4]) * 100 + int(keep_from[5:7])
    df = spark.read.parquet(path)
    kept = df.where((F.col("yyyy") >= cut // 100) & (F.col("yyyy") * 100 + F.col("mm") >= cut))
    dst = f"{out_root}/retained-{uuid.uuid4().hex[:8]}"
    kept.hint("rebalance", *LAKE_PARTITIONS).write.mode("errorifexists").option("compression", "zstd").partitionBy(
        *LAKE_PARTITIONS
    ).parquet(dst)
    return dst


def schema_align(existing: DataFrame, incoming: DataFrame, defaults: dict | None = None,
                 types: dict | None = None) -> DataFrame:
    """Additive schema migration: columns missing on either side are added (NULL, then
    the declared default) and cast to the declared type."""
    out = existing.unionByName(incoming, allowMissingColumns=True)
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    for c, t in (types or {}).items():
        out = out.withColumn(c, F.col(c).cast(t))
    return out
