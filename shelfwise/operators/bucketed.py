"""Month-partitioned facts that are bucketed and sorted by their key.

Within each month the rows lie in ``buckets`` files by the hash of the key. An
upsert shuffles its batch to the same buckets and joins each with the file it
meets: the target's rows are read where they lie, joined, and written back by
the same task, so no exchange moves them. The dynamic partition overwrite
stages its files and swaps them in when all tasks are done, so the months may
be read and replaced by one job, and the rows are written once. The table
itself names that mode, so it does not hang on the session's setting.

Rows with a NULL in their key cannot meet by a plain equality; these few are
merged null-safely beside the others.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import month_trunc
from ..schemas import TableSpec
from ..session import checkpoint_root, path_exists
from .upsert import conform, dedupe_latest, merge, merged_columns

BUCKETS = 16
MONTH = "sell_month"


def buckets_for(month_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets of a table whose busiest month takes ``month_bytes``: one file of a bucket is a task's work."""
    return max(1, -(-month_bytes // bucket_bytes))


def open_table(spark: SparkSession, root: str, spec: TableSpec, buckets: int = BUCKETS) -> str:
    """The catalogue name of the bucketed fact at ``root``, which is made if it is not there.

    A table keeps the number of buckets it was made with (written beside it), whatever is asked for later.
    """
    layout = f"{root}_layout"
    if path_exists(spark, layout):
        buckets = spark.read.schema("buckets int").json(layout).first()["buckets"]
    else:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(layout)
    name = f"fact_{hashlib.sha256(root.encode()).hexdigest()[:24]}"
    if spark.catalog.tableExists(name) and not _is_dynamic(spark, name):
        spark.sql(f"DROP TABLE {name}")  # made by an older release; its files stay, as they lie outside the catalogue
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
        keys = ", ".join(f"`{k}`" for k in spec.keys)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {MONTH} DATE) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({MONTH}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{root}'"
        )
        if path_exists(spark, root):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _detail(spark: SparkSession, name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what).collect()
    return rows[0]["data_type"] if rows else ""


def _is_dynamic(spark: SparkSession, name: str) -> bool:
    return "partitionOverwriteMode=dynamic" in _detail(spark, name, "Storage Properties")


def _buckets_of(spark: SparkSession, name: str) -> int:
    return int(_detail(spark, name, "Num Buckets"))


def merge_bucketed(old: DataFrame, new: DataFrame, spec: TableSpec, buckets: int) -> DataFrame:
    """``merge`` of a conformed batch into rows read from a bucketed table, which are not shuffled."""
    keys = list(spec.keys)
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    fresh = dedupe_latest(new.where(whole).repartition(buckets, *keys), keys)
    o = old.where(whole).select([F.col(c).alias(f"o_{c}") for c in spec.columns]).withColumn("o__in_old", F.lit(True))
    n = fresh.select([F.col(c).alias(f"n_{c}") for c in spec.columns]).withColumn("n__in_new", F.lit(True))
    on = reduce(Column.__and__, [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys])
    # Both sides keep to the buckets: a broadcast or a runtime re-plan would have the target's rows dealt again to be written.
    met = o.hint("merge").join(n, on, "full").select(*merged_columns(spec.columns, keys, spec.updates))
    odd = merge(old.where(~whole).select(*spec.columns), new.where(~whole).select(*spec.columns), keys, spec.updates)
    return met.unionByName(odd.select(*spec.columns))


def upsert_fact(spark: SparkSession, root: str, batch: DataFrame, spec: TableSpec, now: str | None = None, buckets: int = BUCKETS) -> list:
    """Upserts a batch into the bucketed fact at ``root``; the months it touched.

    The batch is staged once under ``spark.checkpoint.dir``; only its months are read and written.
    """
    name = open_table(spark, root, spec, buckets)
    staged = f"{checkpoint_root(spark)}/stage/{spec.name}-batch/{uuid.uuid4().hex}"
    conform(batch, spec, now).withColumn(MONTH, F.to_date(month_trunc(spec.month_col))).write.parquet(staged)
    new = spark.read.parquet(staged)
    months = [r[0] for r in new.select(MONTH).distinct().collect()]
    if not months:
        return []
    spark.catalog.refreshTable(name)
    mine = F.col(MONTH).isin([m for m in months if m is not None])
    old = spark.table(name).where(mine | F.col(MONTH).isNull() if None in months else mine)
    out = merge_bucketed(old, new.select(*spec.columns), spec, _buckets_of(spark, name))
    out = out.withColumn(MONTH, F.to_date(month_trunc(spec.month_col)))
    out.write.insertInto(name, overwrite=True)
    return months


def read_fact(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The fact's rows, with ``sell_month`` to prune by."""
    return spark.table(open_table(spark, root, spec))
