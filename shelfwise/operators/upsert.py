"""Keyed upserts on file tables.

``merge`` is the set semantics of ``INSERT ... ON CONFLICT (keys) DO UPDATE
SET <listed columns>``: matched rows take the listed columns from the batch
and keep the rest (``created_at``); unmatched batch rows are inserted; target
rows absent from the batch stay (nothing is deleted). The batch is first
reduced to one row per key with a partial-aggregating ``max`` so a hot
key never lands whole in one sort.

Writers publish a new snapshot directory (masters) or dynamically overwrite
only the touched month partitions (facts) from a staged copy, so a lost
executor or a failed job never leaves a half-written table behind.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.expr import month_trunc
from ..schemas import TableSpec
from ..session import checkpoint_root, path_exists


def conform(df: DataFrame, spec: TableSpec, now: str | None = None) -> DataFrame:
    """Project a batch onto the target schema, filling declared defaults.

    Missing columns get their default (or NULL); ``created_at``/``updated_at``
    get ``now`` (the load timestamp) when absent.
    """
    cols: list[Column] = []
    have = set(df.columns)
    for f in spec.schema.fields:
        if f.name in have:
            c = F.col(f.name)
            if f.name in spec.defaults:
                c = F.coalesce(c, F.lit(spec.defaults[f.name]))
        elif f.name in ("created_at", "updated_at") and now is not None:
            c = F.lit(now)
        elif f.name in spec.defaults:
            c = F.lit(spec.defaults[f.name])
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def dedupe_latest(df: DataFrame, keys: tuple[str, ...] | list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (whole row breaks ties).

    ``max`` aggregates partially before the shuffle, so duplicated hot keys
    are collapsed map-side; its buffer holds a row once.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    rank = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])], *[F.col(c) for c in payload])
    agg = df.groupBy(*keys).agg(F.max(rank).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]).select(*df.columns)


def merge(
    old: DataFrame | None,
    new: DataFrame,
    keys: tuple[str, ...] | list[str],
    updates: tuple[str, ...] | list[str],
    dedupe: bool = True,
    order: list[str] | None = None,
) -> DataFrame:
    """Insert-or-update of ``new`` into ``old`` by ``keys``; no deletes. ``old`` is None for a table without rows: nothing is joined."""
    keys = list(keys)
    if old is None:
        return dedupe_latest(new, keys, order) if dedupe else new
    cols = old.columns
    if dedupe:
        new = dedupe_latest(new, keys, order)
    o = old.withColumn("_in_old", F.lit(True))
    n = new.select(*cols).withColumn("_in_new", F.lit(True))
    o = o.select([F.col(c).alias(f"o_{c}") for c in o.columns])
    n = n.select([F.col(c).alias(f"n_{c}") for c in n.columns])
    # Null-safe: a row with a NULL key part meets itself on a re-run instead of being added again.
    j = o.join(n, reduce(Column.__and__, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys]), "full")
    return j.select(*merged_columns(cols, keys, updates))


def merged_columns(cols: list[str], keys: list[str], updates: tuple[str, ...] | list[str]) -> list[Column]:
    """The columns of a merged row, from a full join of ``o_`` and ``n_`` columns with o__in_old and n__in_new."""
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(f"o_{c}", f"n_{c}").alias(c))
        elif c in updates:
            out.append(F.when(F.col("n__in_new"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            out.append(F.when(F.col("o__in_old"), F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c))
    return out


def upsert(old: DataFrame, batch: DataFrame, spec: TableSpec, now: str | None = None, order=None) -> DataFrame:
    """``merge`` of a conformed batch into a target with the table's key and update list."""
    return merge(old, conform(batch, spec, now), spec.keys, spec.updates, order=order)


def empty_target(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


# ---------------------------------------------------------------------------
# Snapshot publishing (masters, small targets) and month-partition rewrites.
# ---------------------------------------------------------------------------
MANIFEST = "_manifest"


def _read_manifest(spark: SparkSession, root: str) -> dict | None:
    """Newest committed manifest entry (append-only log of published snapshots)."""
    if not path_exists(spark, f"{root}/{MANIFEST}"):  # new table
        return None
    log = spark.read.schema("ts string, path string").json(f"{root}/{MANIFEST}")
    rows = log.orderBy(F.col("ts").desc()).limit(1).collect()
    return rows[0].asDict() if rows else None


def _write_manifest(spark: SparkSession, root: str, payload: dict) -> None:
    # Each publish appends one small JSON file; the job commit makes it visible
    # atomically, and the previous entries stay valid until the new one lands.
    ts = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    row = spark.createDataFrame([(ts, payload["path"])], "ts string, path string")
    row.coalesce(1).write.mode("append").json(f"{root}/{MANIFEST}")


def read_snapshot(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    found = stored_snapshot(spark, root, spec)
    return empty_target(spark, spec) if found is None else found


def stored_snapshot(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame | None:
    """The newest snapshot; None before the first one."""
    m = _read_manifest(spark, root)
    return spark.read.schema(spec.schema).parquet(m["path"]) if m else None


def publish_snapshot(spark: SparkSession, root: str, df: DataFrame, sort_by: list[str] | None = None) -> str:
    """Write ``df`` to a new snapshot directory, then point the manifest at it.

    Readers of the previous snapshot are never disturbed; a failed write leaves
    the manifest on the old snapshot.
    """
    path = f"{root}/snap={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    w = df.sortWithinPartitions(*sort_by) if sort_by else df
    w.write.mode("errorifexists").parquet(path)
    _write_manifest(spark, root, {"path": path})
    return path


def read_months(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """A fact, or another table written by appending, without its partition column; empty before the first write."""
    if not path_exists(spark, root):
        return empty_target(spark, spec)
    schema = StructType([*spec.schema.fields, StructField("sell_month", DateType())]) if spec.month_col else spec.schema
    return spark.read.schema(schema).parquet(root).select(*spec.columns)


def write_months(
    spark: SparkSession,
    root: str,
    merged_touched: DataFrame,
    spec: TableSpec,
    sort_by: list[str] | None = None,
    replace_all: bool = False,
) -> None:
    """Rewrite only the month partitions present in ``merged_touched``.

    ``replace_all`` (full reset) replaces the whole table instead.

    The merged rows are staged under ``spark.checkpoint.dir`` first (this cuts
    the lineage back to the table being rewritten and survives executor
    loss); then a dynamic partition overwrite swaps in just those months.
    """
    _publish_months(_stage_months(spark, merged_touched, spec), root, sort_by, replace_all)


def _stage_months(spark: SparkSession, rows: DataFrame, spec: TableSpec) -> DataFrame:
    assert spec.month_col
    staged_path = f"{checkpoint_root(spark)}/stage/{spec.name}/{uuid.uuid4().hex}"
    staged = rows.withColumn("sell_month", F.to_date(month_trunc(spec.month_col)))
    staged.write.mode("errorifexists").parquet(staged_path)
    return spark.read.parquet(staged_path)


def _publish_months(back: DataFrame, root: str, sort_by: list[str] | None, replace_all: bool) -> None:
    # rebalance: AQE splits a hot month across writers instead of one task per month.
    w = back.hint("rebalance", "sell_month")
    if sort_by:
        w = w.sortWithinPartitions("sell_month", *sort_by)  # the partitioned writer keeps this order
    (
        w.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy("sell_month")
        .parquet(root)
    )


def upsert_months(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    spec: TableSpec,
    now: str | None = None,
    sort_by: list[str] | None = None,
) -> list:
    """Upsert a fact batch into a month-partitioned table touching only its months, which it returns.

    The conformed batch is computed once: it is staged under
    ``spark.checkpoint.dir`` partitioned by month, the touched months are read
    from the staged partition values (at most the window's month count), and
    the merge reads the staged copy. The old table is read only for those
    months (partition filter), so untouched months are neither read nor written.
    A first load has nothing to merge into: its rows are staged once, one a key.
    """
    assert spec.month_col
    if not path_exists(spark, root):
        back = _stage_months(spark, dedupe_latest(conform(batch, spec, now), spec.keys), spec)
        months = [r[0] for r in back.select("sell_month").distinct().collect()]
        if months:
            _publish_months(back, root, sort_by, replace_all=False)
        return months
    staged_path = f"{checkpoint_root(spark)}/stage/{spec.name}-batch/{uuid.uuid4().hex}"
    b = conform(batch, spec, now).withColumn("sell_month", F.to_date(month_trunc(spec.month_col)))
    b.hint("rebalance", "sell_month").write.partitionBy("sell_month").parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    months = [r[0] for r in staged.select("sell_month").distinct().collect()]
    if not months:
        return []
    # Partition discovery gives sell_month; the isin list prunes untouched months.
    old = spark.read.parquet(root).where(F.col("sell_month").isin(months)).select(*spec.columns)
    write_months(spark, root, merge(old, staged.select(*spec.columns), spec.keys, spec.updates), spec, sort_by)
    return months
