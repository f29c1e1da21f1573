"""Registered queries for the streaming jobs: run to completion (availableNow), read the sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import positive
from ..operators.keys import fk_semi_filter
from ..sources.views import settings_from_events
from ..streaming import sync as ST
from .catalog import register
from .q_layout import scratch
from .q_load import STOCK_CTES, full

SETTING_COLS = ["shop_id", "product_group_id", "setting_id", "min_qty", "max_qty", "sell_multiply", "show_qty",
                "updated_at"]


def _events_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return ST.file_stream(spark, sf, schema, glob="events.parquet")


def _template(spark, df):
    return spark.createDataFrame([], df.schema)


@register(
    "stream_delta_sync",
    f"select {', '.join(SETTING_COLS)} from t_setting_latest",
    STOCK_CTES,
)
def q_stream_delta_sync(spark, sf):
    branches = full(spark, sf).branches

    def transform(batch):
        s = settings_from_events(batch).where(positive("shop_id", "product_group_id"))
        s = fk_semi_filter(s, {"shop_id": branches}, require_positive=False)
        return s.withColumnRenamed("id", "setting_id").select(*SETTING_COLS)

    template = _template(spark, transform(spark.read.parquet(f"{sf}/events.parquet").limit(0)))
    root = scratch(spark, "stream_targets")
    ST.stream_delta_sync(spark, _events_stream(spark, sf), transform, root,
                         ["shop_id", "product_group_id"], "setting_id", template)
    return ST.read_bucketed(spark, root, template)


def _changes(df):
    return df.select(
        F.col("user_id").alias("user_key"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"),
        "event_type", "value", "ts",
    )


@register(
    "stream_cdc_apply",
    """select user_id as user_key, event_id as seq, 'U' as op, event_type, value, ts
       from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
       where rn = 1 and event_type <> 'error'""",
)
def q_stream_cdc_apply(spark, sf):
    template = _template(spark, _changes(spark.read.parquet(f"{sf}/events.parquet").limit(0)))
    root = scratch(spark, "cdc_state")
    ST.stream_cdc_apply(spark, _changes(_events_stream(spark, sf)), root, ["user_key"], "seq", template=template)
    return ST.cdc_table(spark, root, template)


@register("stream_late_data", "select distinct event_id, ts, user_id, event_type, value from events")
def q_stream_late_data(spark, sf):
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    # Two readers of the same feed: every event arrives twice and must be kept once.
    twice = _events_stream(spark, sf).select(*cols).unionByName(_events_stream(spark, sf).select(*cols))
    out = scratch(spark, "late_out")
    ST.stream_late_data(spark, twice, out, "ts", ["event_id"])
    return spark.read.parquet(out).select(*cols)


@register(
    "stream_stock",
    """select cast(user_id % 25 as integer) as shop_id, round(sum(value), 6) as value_total, count(*) as n_moves
       from events group by all""",
)
def q_stream_stock(spark, sf):
    moves = _events_stream(spark, sf).select((F.col("user_id") % 25).cast("int").alias("shop_id"), "value")
    template = spark.createDataFrame([], "shop_id int, value_total double, n_moves bigint")
    root = scratch(spark, "stream_stock")
    ST.stream_stock(spark, moves, root, ["shop_id"], {"value_total": "value"}, template)
    out = ST.read_bucketed(spark, root, template)
    return out.select("shop_id", F.round("value_total", 6).alias("value_total"), "n_moves")
