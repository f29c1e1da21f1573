"""Structured Streaming jobs: delta sync, change-feed apply, late-data dedupe, running stock.

All four read a file directory source with an explicit schema and write
through sinks that survive a replayed micro-batch:

* ``foreachBatch`` upserts are *keyed and ordered* (the newest version of a
  key wins by a sequence column), so re-applying a batch after a failure
  changes nothing;
* state lives in the checkpoint under ``spark.checkpoint.dir``;
* tests and the registered queries use ``trigger(availableNow=True)``, the
  service uses ``processingTime`` (1–5 minutes).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import MapType, StructType

from ..functions.expr import month_trunc
from ..operators.quality import dlq
from ..session import checkpoint_root, path_exists


def file_stream(spark: SparkSession, directory: str, schema: StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def _checkpoint(spark: SparkSession, name: str, target: str) -> str:
    """One folder per stream and target: a restarted stream resumes where it stopped."""
    return f"{checkpoint_root(spark)}/streams/{name}/{hashlib.sha256(target.encode()).hexdigest()[:32]}"


def _run(writer, available_now: bool, interval: str) -> StreamingQuery:
    """Runs what is there and waits, or starts the service; the handle shows failures of the latter."""
    q = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


STATE_BUCKETS = 64  # hash buckets of keyed streaming state (files rewritten per batch: touched buckets only)


def latest_by_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key: the greatest ``seq`` (partial ``max_by``, hot keys combine map-side).

    A NULL sequence ranks below every other; of equal sequences the greatest row
    wins, so the result does not depend on the order of arrival.
    """
    payload = [c for c in df.columns if c not in keys]
    ordered = [c for c in payload if c != seq and not isinstance(df.schema[c].dataType, MapType)]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(seq, *ordered)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload])


def merge_latest(current: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Order-independent, replay-safe upsert: newest ``seq`` per key across old and new."""
    return latest_by_key(current.unionByName(batch.select(*current.columns)), keys, seq)


def stream_delta_sync(
    spark: SparkSession,
    source: DataFrame,
    transform,
    target_root: str,
    keys: Sequence[str],
    seq: str,
    template: DataFrame,
    available_now: bool = True,
    interval: str = "1 minute",
    buckets: int = STATE_BUCKETS,
    dlq_root: str | None = None,
) -> StreamingQuery:
    """Poll a source directory; each micro-batch is transformed and upserted (latest ``seq`` wins).

    ``template`` gives the target's columns. The target is hash-bucketed by key
    and a micro-batch rewrites only the buckets it touches (``read_bucketed``
    reads it back). Size ``buckets`` by the state (one bucket is rewritten as a
    whole); it must not change over a target's life. With ``dlq_root`` rows
    without a sequence are set aside there instead of ranking last.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        new = transform(batch)
        if dlq_root:
            new = set_aside(new, F.col(seq).isNull(), f"no_{seq}", dlq_root, "delta_sync", keys, epoch)
        upsert_bucketed(spark, target_root, latest_by_key(new, keys, seq), keys, seq, template, buckets)

    w = source.writeStream.foreachBatch(apply).option("checkpointLocation", _checkpoint(spark, "delta_sync", target_root))
    return _run(w, available_now, interval)


def set_aside(batch: DataFrame, bad: Column, reason: str, dlq_root: str, source: str, keys: Sequence[str], epoch: int) -> DataFrame:
    """Writes the ``bad`` rows of a micro-batch as dead letters and returns the others.

    One partition a source and epoch, overwritten when the batch is replayed.
    """
    letters = dlq(batch.where(bad).withColumn("_reason", F.lit(reason)), source, list(keys), "_reason")
    letters = letters.withColumns({"source": F.lit(source), "epoch": F.lit(epoch).cast("long")})
    letters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "epoch").parquet(dlq_root)
    return batch.where(~F.coalesce(bad, F.lit(False)))


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def read_bucketed(spark: SparkSession, root: str, template: DataFrame, buckets: list[int] | None = None) -> DataFrame:
    """Current keyed state (optionally only some buckets); empty before the first batch."""
    if not path_exists(spark, root):  # nothing written yet
        return template.limit(0)
    df = spark.read.parquet(root)
    if buckets is not None:
        df = df.where(F.col("_bucket").isin(buckets))
    return df.select(*template.columns)


def upsert_bucketed(spark: SparkSession, root: str, batch: DataFrame, keys: Sequence[str], seq: str,
                    template: DataFrame, buckets: int = STATE_BUCKETS) -> None:
    """Merge a batch into hash-bucketed state, rewriting only the buckets it touches.

    The touched-bucket list has at most ``buckets`` entries. Merged rows are
    staged under ``spark.checkpoint.dir`` and then swapped in with a dynamic
    partition overwrite, so the state is never read and overwritten by the
    same job, and a replayed batch re-writes identical rows.
    """
    b = batch.withColumn("_bucket", _bucket(keys, buckets)).persist()  # read for the bucket list and for the merge
    touched = [r[0] for r in b.select("_bucket").distinct().collect()]
    if not touched:
        b.unpersist()
        return
    cur = read_bucketed(spark, root, template, touched).withColumn("_bucket", _bucket(keys, buckets))
    merged = latest_by_key(cur.unionByName(b.select(*cur.columns)), [*keys, "_bucket"], seq)
    staged = f"{checkpoint_root(spark)}/stage/state/{uuid.uuid4().hex}"
    merged.write.parquet(staged)
    b.unpersist()
    (
        spark.read.parquet(staged).repartition("_bucket").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(root)
    )


def stream_cdc_apply(
    spark: SparkSession,
    changes: DataFrame,
    state_root: str,
    keys: Sequence[str],
    seq: str,
    op_col: str = "op",
    delete_op: str = "D",
    template: DataFrame | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    buckets: int = STATE_BUCKETS,
    dlq_root: str | None = None,
) -> StreamingQuery:
    """Apply a change feed: last change per key wins; deletes are kept as tombstones in the
    state so that an older, late upsert cannot resurrect a deleted key. ``buckets`` and
    ``dlq_root`` as in ``stream_delta_sync``."""

    def apply(batch: DataFrame, epoch: int) -> None:
        if dlq_root:
            batch = set_aside(batch, F.col(seq).isNull(), f"no_{seq}", dlq_root, "cdc", keys, epoch)
        last = latest_by_key(batch, keys, seq)
        upsert_bucketed(spark, state_root, last, keys, seq, template if template is not None else last, buckets)

    w = changes.writeStream.foreachBatch(apply).option("checkpointLocation", _checkpoint(spark, "cdc", state_root))
    return _run(w, available_now, interval)


def cdc_table(spark: SparkSession, state_root: str, template: DataFrame, op_col: str = "op",
              delete_op: str = "D") -> DataFrame:
    """The applied table: state without tombstones."""
    state = read_bucketed(spark, state_root, template)
    return state.where(F.col(op_col) != delete_op)


def stream_late_data(
    spark: SparkSession,
    events: DataFrame,
    out_path: str,
    ts_col: str,
    keys: Sequence[str],
    delay: str = "7 days",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Insert-only feed with late and repeated rows: watermark + dedupe within it, appended to files.

    ``withWatermark`` needs a zoned ``timestamp``; driver timestamps read as
    ``timestamp_ntz`` and are cast first (the original column is kept). Files
    are laid out by ``event_month``. Rows that come after the watermark are not
    written; ``stream_late_rejects`` finds them.
    """
    ev = events.where(F.col(ts_col).isNotNull()).withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    dedup = ev.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")
    w = (
        dedup.withColumn("event_month", _event_month(ts_col)).writeStream.format("parquet")
        .option("path", out_path)
        .partitionBy("event_month")
        .option("checkpointLocation", _checkpoint(spark, "late", out_path))
        .outputMode("append")
    )
    return _run(w, available_now, interval)


def _event_month(ts_col: str) -> Column:
    return F.date_format(month_trunc(ts_col), "yyyy-MM")


def stream_late_rejects(
    spark: SparkSession,
    events: DataFrame,
    out_path: str,
    dlq_root: str,
    ts_col: str,
    keys: Sequence[str],
) -> StreamingQuery:
    """The side output of ``stream_late_data``: rows of the feed whose key it never wrote, as dead letters.

    Runs over what is there, after ``stream_late_data`` has read it: an event
    that came past the watermark, or without a time, is in no file. Each
    micro-batch is anti-joined with the written months of its own events only: a
    repeated event is taken to carry the time it had. Own checkpoint: a restart goes on where
    it stopped, and a replayed batch overwrites its letters. Repeated rows of a
    written key are duplicates and not set aside.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        month = _event_month(ts_col)
        lo, hi = batch.agg(F.min(month), F.max(month)).first()
        rest = batch
        if lo is not None and path_exists(spark, f"{out_path}/_spark_metadata"):
            written = spark.read.parquet(out_path).where(F.col("event_month").between(lo, hi)).select(*keys).distinct()
            rest = batch.join(written, list(keys), "left_anti")
        timeless = F.col(ts_col).isNull()
        none = F.lit(True)
        rest = set_aside(rest, timeless, f"no_{ts_col}", dlq_root, "late_data_timeless", keys, epoch)
        set_aside(rest, none, "past_watermark", dlq_root, "late_data", keys, epoch)

    w = events.writeStream.foreachBatch(apply).option("checkpointLocation", _checkpoint(spark, "late_rejects", out_path))
    return _run(w, True, "")


def stream_stock(
    spark: SparkSession,
    moves: DataFrame,
    target_root: str,
    keys: Sequence[str],
    measures: dict[str, str],
    template: DataFrame,
    available_now: bool = True,
    interval: str = "1 minute",
    buckets: int = STATE_BUCKETS,
) -> StreamingQuery:
    """Running totals per key (state store, update mode); each batch upserts the changed keys.

    The state store holds the totals, so an updated key's row simply replaces
    the stored one (a replayed batch rewrites the same values); the output
    table is hash-bucketed and only the buckets of updated keys are rewritten.
    """
    aggs = [F.sum(c).alias(n) for n, c in measures.items()] + [F.count(F.lit(1)).alias("n_moves")]
    running = moves.groupBy(*keys).agg(*aggs)

    def apply(batch: DataFrame, epoch: int) -> None:
        stamped = batch.select(*template.columns).withColumn("_epoch", F.lit(epoch).cast("bigint"))
        tmpl = template.withColumn("_epoch", F.lit(0).cast("bigint"))
        upsert_bucketed(spark, target_root, stamped, keys, "_epoch", tmpl, buckets)

    w = (
        running.writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", _checkpoint(spark, "stock", target_root))
    )
    return _run(w, available_now, interval)
