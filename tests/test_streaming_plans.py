"""Streaming equals batch; plan properties (pushdown, broadcast, no Python in the core)."""

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import sync as ST
from tests.conftest import SF_SMALL, rows


@pytest.fixture()
def event_dir(spark, scratch):
    """The events table split into 4 files, streamed one file per micro-batch."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = f"{scratch}/events"
    ev.repartitionByRange(4, "event_id").write.parquet(path)
    return path, ev


def test_cdc_stream_equals_batch(spark, scratch, event_dir):
    path, ev = event_dir

    def changes(df):
        return df.select(F.col("user_id").alias("k"), F.col("event_id").alias("seq"),
                         F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"), "value")

    template = spark.createDataFrame([], changes(ev).schema)
    stream = changes(ST.file_stream(spark, path, ev.schema, max_files=1))
    root = f"{scratch}/cdc"
    ST.stream_cdc_apply(spark, stream, root, ["k"], "seq", template=template)
    got = ST.cdc_table(spark, root, template)
    batch = ST.latest_by_key(changes(ev), ["k"], "seq").where("op != 'D'")
    assert rows(got) == rows(batch)


def test_stock_stream_equals_batch_and_late_dedupe(spark, scratch, event_dir):
    path, ev = event_dir
    moves = ST.file_stream(spark, path, ev.schema, max_files=1).select(
        (F.col("user_id") % 25).cast("int").alias("shop_id"), "value")
    template = spark.createDataFrame([], "shop_id int, total double, n_moves bigint")
    root = f"{scratch}/stock"
    ST.stream_stock(spark, moves, root, ["shop_id"], {"total": "value"}, template)
    got = ST.read_bucketed(spark, root, template).select("shop_id", F.round("total", 6).alias("t"), "n_moves")
    want = ev.groupBy((F.col("user_id") % 25).cast("int").alias("shop_id")).agg(
        F.round(F.sum("value"), 6).alias("t"), F.count(F.lit(1)).alias("n_moves"))
    assert rows(got) == rows(want)

    cols = ["event_id", "ts", "user_id"]
    twice = ST.file_stream(spark, path, ev.schema).select(*cols).unionByName(
        ST.file_stream(spark, path, ev.schema).select(*cols))
    out = f"{scratch}/late"
    ST.stream_late_data(spark, twice, out, "ts", ["event_id"])
    assert spark.read.parquet(out).count() == ev.count()


def _plan(df):
    """The formatted physical plan (what ``df.explain("formatted")`` prints)."""
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_range_filter_reaches_scan_and_keysets_broadcast(spark):
    import __spark_entry__ as E

    df = E.queries()["join_detail_header"](spark, SF_SMALL)
    txt = _plan(df)
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01T00:00)" in txt
    assert "LessThanOrEqual(o_orderdate,1998-02-28T23:59:59)" in txt
    plan = _plan(E.queries()["load_sell_detail"](spark, SF_SMALL))
    assert plan.count("BroadcastExchange") >= 3


@pytest.mark.parametrize("name", ["load_sell_detail", "load_stock_balance", "sales_trend", "forecast_compare",
                                  "target_cover", "rebalance_stock", "upsert_sell_details", "dq_not_null"])
def test_core_plans_stay_in_the_jvm(spark, name):
    import __spark_entry__ as E

    txt = _plan(E.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert node not in txt, f"{name} runs Python: {node}"


def test_fact_range_reader_prunes_month_partitions(spark, scratch):
    import datetime as dt

    from shelfwise import schemas as S
    from shelfwise.operators.upsert import upsert_months
    from shelfwise.sources.tables import read_fact_range

    root = f"{scratch}/sell"
    days = [dt.datetime(2026, m, 10) for m in range(1, 7)]
    batch = spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)], "id bigint, shop_id int, sell_date timestamp_ntz")
    upsert_months(spark, root, batch, S.SELL, "2026-01-01 00:00:00")
    df = read_fact_range(spark, root, "2026-02-01", "2026-03-31")
    txt = _plan(df)
    assert "PartitionFilters: [isnotnull(sell_month" in txt and "2026-02-01" in txt
    assert sorted(r.id for r in df.collect()) == [1, 2]


def test_short_window_broadcasts_headers_long_window_shuffles(spark):
    from shelfwise.plans import loads as L
    from shelfwise.sources.views import Domain

    d = Domain(spark, SF_SMALL)
    short = _plan(L.join_detail_header(d.v_sell_detail, d.v_sell, "1996-03-01", "1996-03-07"))
    long = _plan(L.join_detail_header(d.v_sell_detail, d.v_sell, "1995-01-01", "2001-12-31"))
    assert "SortMergeJoin" not in short  # the detail is scanned once, never shuffled
    assert "SortMergeJoin" in long  # much of the detail is kept: its work is spread by the shuffle
    # A short window whose headers would not fit, and a window without an end, are not broadcast either.
    large = _plan(L.join_detail_header(d.v_sell_detail, d.v_sell, "1996-03-01", "1996-03-07", header_broadcast_bytes=100))
    half = _plan(L.join_detail_header(d.v_sell_detail, d.v_sell, "1996-03-01", None))
    assert "SortMergeJoin" in large and "SortMergeJoin" in half


def test_bucketed_state_rewrites_only_touched_buckets(spark, scratch):
    from shelfwise.streaming.sync import read_bucketed, upsert_bucketed

    root = f"{scratch}/state"
    template = spark.createDataFrame([], "k int, v string, seq long")
    first = spark.createDataFrame([(i, "a", 1) for i in range(200)], template.schema)
    upsert_bucketed(spark, root, first, ["k"], "seq", template, buckets=16)
    files = {r[0] for r in spark.read.parquet(root).select(F.input_file_name()).collect()}
    batch = spark.createDataFrame([(3, "b", 2), (3, "old", 0)], template.schema)
    upsert_bucketed(spark, root, batch, ["k"], "seq", template, buckets=16)
    after = spark.read.parquet(root)
    touched = after.where("k = 3").select("_bucket").first()[0]
    untouched = {r[0] for r in after.where(F.col("_bucket") != touched).select(F.input_file_name()).collect()}
    assert untouched <= files  # other buckets' files were not rewritten
    got = {r.k: (r.v, r.seq) for r in read_bucketed(spark, root, template).collect()}
    assert len(got) == 200 and got[3] == ("b", 2)  # newest sequence wins, nothing lost


def test_cluster_conf_scales_with_input():
    from shelfwise.session import cluster_conf

    small = cluster_conf(10 * 1024 ** 3)
    huge = cluster_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(huge["spark.sql.shuffle.partitions"]) == 100_000
    assert huge["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_late_copies_in_later_batches_are_deduplicated(spark, scratch, event_dir):
    path, ev = event_dir
    reversed_dir = f"{scratch}/events_rev"
    # The same events again, file order reversed: copies of the newest events arrive first, the oldest last.
    ev.withColumn("_o", -F.col("event_id")).repartitionByRange(4, "_o").drop("_o").write.parquet(reversed_dir)
    cols = ["event_id", "ts", "user_id"]
    a = ST.file_stream(spark, path, ev.schema, max_files=1).select(*cols)
    b = ST.file_stream(spark, reversed_dir, ev.schema, max_files=1).select(*cols)
    out = f"{scratch}/late_cross"
    ST.stream_late_data(spark, a.unionByName(b), out, "ts", ["event_id"], delay="60 days")
    got = spark.read.parquet(out)
    assert got.count() == ev.count() == got.select("event_id").distinct().count()
