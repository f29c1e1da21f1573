"""Ties, NULL keys, duplicate keys, mid-month reloads, restarts and unset folders."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import planning as PL
from shelfwise.operators import quality as Q
from shelfwise.operators import series as SR
from shelfwise.operators import similar as SIM
from shelfwise.operators.upsert import merge, write_months
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.streaming import sync as ST
from shelfwise.plans.params import NOW
from tests.conftest import rows


def test_similar_products_ties_go_to_smaller_ids(spark):
    cat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(1, 101)], "id long, embedding array<float>")
    queries = spark.createDataFrame([(0, [1.0, 2.0])], "query_id long, embedding array<float>")
    for parts in (1, 7):
        got = SIM.similar_products(cat.repartition(parts), queries, k=5).collect()
        assert [r.id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]


def test_mid_month_reload_keeps_the_start_of_the_month(spark):
    fact = spark.createDataFrame(
        [(1, 1, dt.datetime(2026, 1, 3), 5), (2, 1, dt.datetime(2026, 1, 20), 7), (3, 1, dt.datetime(2026, 3, 1), 9)],
        "sell_id int, shop_id int, sell_date timestamp_ntz, qty int")
    assert SR.touched_range("2026-01-15", "2026-02-22") == ("2026-01-01", "2026-02-28")
    current = SR.monthly(fact.where("sell_id != 2"), ["shop_id"])
    lo, hi = SR.touched_range("2026-01-15", "2026-01-22")
    touched = fact.where(F.col("sell_date").between(lo, f"{hi} 23:59:59"))
    for given in (touched, fact):  # rows of other months do no harm
        assert rows(SR.agg_incremental(current, given, ["shop_id"], "2026-01-15", "2026-01-22")) == rows(SR.monthly(fact, ["shop_id"]))


def test_audit_finds_rows_with_nullified_columns(spark):
    source = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id int, shop_id int")
    target = spark.createDataFrame([(1, None), (2, None)], "id int, shop_id int")
    got = {r.id: (r.shop_id_match, r.found) for r in Q.audit_sample(source, target, "id", ["shop_id"]).collect()}
    assert got == {1: (False, True), 2: (True, True), 3: (False, False)}


def test_target_cover_sums_products_without_type(spark):
    stock = spark.createDataFrame([(1, 10, 4), (1, 11, 6)], "shop_id int, product_id int, qty int")
    sold = spark.createDataFrame([], "shop_id int, product_id int, truesell_qty_7_day double, truesell_qty_30_day double")
    products = spark.createDataFrame([(10, 1, None), (11, 1, None)], "id int, group_id int, type_id int")
    targets = spark.createDataFrame([], S.STOCK_TARGETS.schema)
    got = PL.target_cover(stock, sold, products, targets).select("current_qty_by_type").collect()
    assert [r[0] for r in got] == [10.0, 10.0]


def test_null_keys_do_not_multiply(spark):
    old = spark.createDataFrame([(None, 1, "a"), (1, 1, "b")], "k int, j int, v string")
    once = merge(old, spark.createDataFrame([(None, 1, "c"), (2, None, "d")], old.schema), ["k", "j"], ["v"])
    twice = merge(once, spark.createDataFrame([(None, 1, "c"), (2, None, "d")], old.schema), ["k", "j"], ["v"])
    assert rows(once) == rows(twice) and once.count() == 3


def test_full_load_keeps_one_row_a_key(spark, scratch, monkeypatch):
    from shelfwise.plans import loads as L
    from shelfwise.sources.views import Domain
    from tests.conftest import SF_SMALL

    d = Domain(spark, SF_SMALL)
    doubled = SimpleNamespace(**{v: getattr(d, v) for v in ("v_shop", "v_company", "v_product", "v_stock_shop", "v_setting", "v_sell_detail")},
                              v_sell=d.v_sell.unionByName(d.v_sell))
    args = ("2001-08-01", "1996-01-01", "1996-02-28")
    L.run_load(spark, doubled, f"{scratch}/daily", "repair", *args, now=NOW)
    L.run_load(spark, doubled, f"{scratch}/full", "repair", *args, reset=True, now=NOW)
    got = [rows(spark.read.parquet(f"{scratch}/{m}/sell")) for m in ("daily", "full")]
    assert got[0] == got[1] and len(got[0]) > 0


def test_fact_files_are_sorted_by_shop(spark, scratch):
    data = [(i, (i * 7) % 13, dt.datetime(2026, 1 + i % 3, 1 + i % 27), None) for i in range(500)]
    write_months(spark, f"{scratch}/sell", spark.createDataFrame(data, S.SELL.schema), S.SELL, ["shop_id", "sell_date"])
    files = spark.read.parquet(f"{scratch}/sell").select(F.input_file_name().alias("f"), "shop_id").collect()
    by = {}
    for r in files:
        by.setdefault(r.f, []).append(r.shop_id)
    assert len(by) >= 3 and all(x == sorted(x) for x in by.values())


@pytest.mark.parametrize("kind", ["late", "stock", "delta", "cdc"])
def test_restarted_streams_go_on(spark, scratch, kind):
    src = f"{scratch}/src"
    schema = "id long, ts timestamp_ntz, value double, op string"
    state = spark.createDataFrame([], schema)

    def run():
        stream = ST.file_stream(spark, src, state.schema, max_files=1)
        if kind == "late":
            ST.stream_late_data(spark, stream, f"{scratch}/out", "ts", ["id"])
            return spark.read.parquet(f"{scratch}/out").count()
        if kind == "stock":
            t = spark.createDataFrame([], "k int, total double, n_moves bigint")
            ST.stream_stock(spark, stream.select((F.col("id") % 2).cast("int").alias("k"), "value"), f"{scratch}/out", ["k"], {"total": "value"}, t)
            return ST.read_bucketed(spark, f"{scratch}/out", t).agg(F.sum("n_moves")).first()[0]
        if kind == "delta":
            ST.stream_delta_sync(spark, stream, lambda b: b, f"{scratch}/out", ["id"], "value", state)
        else:
            ST.stream_cdc_apply(spark, stream, f"{scratch}/out", ["id"], "value", template=state)
        return ST.read_bucketed(spark, f"{scratch}/out", state).count()

    for n in (10, 20):
        add = [(i, dt.datetime(2026, 1, 1, 0, i), float(i), "U") for i in range(n - 10, n)]
        spark.createDataFrame(add, schema).coalesce(1).write.mode("append").parquet(src)
        assert run() == n


def test_a_cluster_must_name_its_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)


def test_audit_strata_never_broadcasts_the_target(spark, scratch):
    target = spark.range(50_000).select("id", (F.col("id") % 5).cast("int").alias("shop_id"), F.lit(1).alias("qty"))
    target.write.parquet(f"{scratch}/t")  # small files
    source = spark.range(-20, 900).select("id", (F.col("id") % 5).cast("int").alias("shop_id"), F.when(F.col("id") % 2 == 0, 1).alias("qty"))
    got = Q.audit_strata(source, spark.read.parquet(f"{scratch}/t"), "t", ["id"], ["shop_id"], ["qty"], 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin LeftOuter" not in plan.replace("[", " ") and "Join LeftOuter" not in plan.replace("SortMergeJoin", "")
    assert ", LeftOuter, BuildRight" not in plan and ", LeftSemi, BuildRight" in plan
    for r in got.collect():
        assert r.found == (int(r.row_key) >= 0) and r.same == (r.found and int(r.row_key) % 2 == 0)
    assert got.count() == 3 * source.select("shop_id").distinct().count()
