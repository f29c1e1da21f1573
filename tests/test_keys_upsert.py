"""Key membership (Q6-Q10) and upsert semantics (Q15-Q19, Q23), with properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import keys as K
from shelfwise.operators.upsert import merge, publish_snapshot, read_snapshot, upsert, upsert_months
from tests.conftest import rows

T0 = "2026-01-01 00:00:00"
T1 = "2026-02-01 00:00:00"


def test_fk_nullify_keeps_rows(spark):
    df = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, shop_id int")
    valid = spark.createDataFrame([(10,)], "id int")
    out = K.fk_nullify(df, {"shop_id": valid})
    assert rows(out) == [(1, 10), (2, None), (3, None)]  # Q6: unknown -> NULL, row kept


def test_fk_semi_and_reject_partition_input(spark):
    df = spark.createDataFrame([(10, 1, 5), (0, 1, 5), (11, 1, 5), (10, 2, 5), (10, None, 5)],
                               "shop_id int, product_id int, qty int")
    shops = spark.createDataFrame([(10,), (0,)], "id int")
    prods = spark.createDataFrame([(1,)], "id int")
    checks = {"shop_id": shops, "product_id": prods}
    kept = K.fk_semi_filter(df, checks)
    rej = K.fk_reject(df, checks)
    assert rows(kept) == [(10, 1, 5)]  # Q7: non-positive (0) dropped even though "valid"
    assert kept.count() + rej.count() == df.count()
    reasons = {(r.shop_id, r.product_id): r.fk_reason for r in rej.collect()}
    assert reasons[(11, 1)] == "unknown_shop_id"
    assert reasons[(10, None)] == "unknown_product_id"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-2, 6), st.integers(-2, 6)), min_size=0, max_size=30),
       st.sets(st.integers(-2, 6), max_size=5))
def test_property_kept_plus_rejected_is_input(spark, data, valid_ids):
    df = spark.createDataFrame(data, "shop_id int, product_id int")
    valid = spark.createDataFrame([(v,) for v in valid_ids], "id int")
    checks = {"shop_id": valid, "product_id": valid}
    kept = K.fk_semi_filter(df, checks)
    rej = K.fk_reject(df, checks).drop("fk_reason")
    assert rows(kept.unionByName(rej)) == rows(df)
    nulled = K.fk_nullify(df, {"shop_id": valid})
    assert nulled.count() == df.count()


def test_bounded_broadcast_falls_back_above_bound(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    fact = spark.range(1000).withColumn("k", F.col("id") % 100)
    plan_small = fact.join(K.bounded_broadcast(big, 1000), "k")._jdf.queryExecution().executedPlan().toString()
    plan_big = fact.join(K.bounded_broadcast(big, 10), "k")
    assert "Broadcast" in plan_small
    assert plan_big.count() == 1000


def test_key_lookup_flags_missing(spark):
    keys = spark.createDataFrame([(1,), (2,)], "id int")
    t = spark.createDataFrame([(1, "a")], "id int, name string")
    assert rows(K.key_lookup(keys, t)) == [(1, "a", True), (2, None, False)]


def _branches(spark, data, ts):
    df = spark.createDataFrame(data, "id int, code string, name string, is_active boolean")
    return df.withColumn("created_at", F.lit(ts).cast("timestamp_ntz")).withColumn(
        "updated_at", F.lit(ts).cast("timestamp_ntz"))


def test_upsert_updates_listed_keeps_created_never_deletes(spark):
    old = _branches(spark, [(1, "A", "Old", True), (2, "B", "Gone", True)], T0)
    batch = spark.createDataFrame([(1, "A", "New", False), (3, "C", "Fresh", True)],
                                  "id int, code string, name string, is_active boolean")
    out = {r.id: r for r in upsert(old, batch, S.BRANCHES, T1).collect()}
    assert out[1].name == "New" and out[1].is_active is False
    assert out[1].created_at == dt.datetime(2026, 1, 1)  # Q16
    assert out[1].updated_at == dt.datetime(2026, 2, 1)
    assert out[2].name == "Gone"  # Q15: absent from the batch, kept
    assert out[3].created_at == dt.datetime(2026, 2, 1)


def test_upsert_idempotent_and_keyed_unique(spark):
    old = _branches(spark, [(1, "A", "x", True)], T0)
    batch = spark.createDataFrame([(1, "A", "y", True), (2, "B", "z", True)],
                                  "id int, code string, name string, is_active boolean")
    once = upsert(old, batch, S.BRANCHES, T1)
    twice = upsert(once, batch, S.BRANCHES, T1)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert twice.groupBy("id").count().where("count > 1").count() == 0


def test_duplicate_keys_in_batch_resolved_deterministically(spark):
    # Q23: duplicates inside a batch are reduced to one row (greatest order column wins).
    old = spark.createDataFrame([], "id int, v string, seq int")
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2)], "id int, v string, seq int")
    out = merge(old, batch, ["id"], ["v", "seq"], order=["seq"]).collect()
    assert [(r.id, r.v) for r in out] == [(1, "b")]


def test_moved_sell_date_keeps_both_rows(spark):
    # Q17: the fact key includes the date.
    old = spark.createDataFrame([(7, 1, dt.datetime(2026, 1, 5))], "id bigint, shop_id int, sell_date timestamp_ntz")
    batch = spark.createDataFrame([(7, 1, dt.datetime(2026, 2, 5))], "id bigint, shop_id int, sell_date timestamp_ntz")
    assert upsert(old.withColumn("created_at", F.lit(None).cast("timestamp_ntz")), batch, S.SELL, T1).count() == 2


def test_stock_upsert_resets_planning_columns(spark):
    # Q18: the stock load carries only shop, product, qty; the other columns go back to defaults.
    from shelfwise.operators.upsert import conform

    old = conform(spark.createDataFrame([(1, 2, 5)], "shop_id int, product_id int, qty int"), S.STOCK_BALANCE, T0)
    old = old.withColumn("po_qty", F.lit(9.0)).withColumn("po_status", F.lit("ordered"))
    batch = spark.createDataFrame([(1, 2, 7)], "shop_id int, product_id int, qty bigint")
    r = upsert(old, batch, S.STOCK_BALANCE, T1).first()
    assert (r.qty, r.po_qty, r.po_status) == (7, 0.0, S.PO_STATUS_DEFAULT)


def test_snapshot_publish_and_month_rewrite(spark, scratch):
    df = _branches(spark, [(1, "A", "x", True)], T0)
    publish_snapshot(spark, f"{scratch}/b", df)
    publish_snapshot(spark, f"{scratch}/b", df.withColumn("name", F.lit("y")))
    assert read_snapshot(spark, f"{scratch}/b", S.BRANCHES).first().name == "y"

    root = f"{scratch}/sell"
    jan = spark.createDataFrame([(1, 1, dt.datetime(2026, 1, 5)), (2, 1, dt.datetime(2026, 2, 5))],
                                "id bigint, shop_id int, sell_date timestamp_ntz")
    upsert_months(spark, root, jan, S.SELL, T0)
    feb_files = {r[0] for r in spark.read.parquet(root).where("sell_month = '2026-02-01'")
                 .select(F.input_file_name()).collect()}
    batch = spark.createDataFrame([(1, 9, dt.datetime(2026, 1, 5))], "id bigint, shop_id int, sell_date timestamp_ntz")
    upsert_months(spark, root, batch, S.SELL, T1)
    back = spark.read.parquet(root)
    assert rows(back, "id", "shop_id") == [(1, 9), (2, 1)]
    feb_after = {r[0] for r in back.where("sell_month = '2026-02-01'").select(F.input_file_name()).collect()}
    assert feb_files == feb_after  # the untouched month was not rewritten
    assert back.where("id = 1").first().created_at == dt.datetime(2026, 1, 1)


def test_row_rule_rejects_feed_the_dead_letter_table(spark):
    from shelfwise.operators.quality import dlq, dq_row_rejects

    df = spark.createDataFrame([(1, "click", 1.0, 2.0, "ab"), (2, "error", 3.0, 2.0, "abcdef"),
                                (3, None, None, 2.0, "ab")], "id int, kind string, a double, b double, name string")
    rej = dq_row_rejects(df, in_set={"kind": ["click"]}, compare=[("a", "b")], lengths={"name": 4})
    out = {r.row_key: r.reason for r in dlq(rej, "events", ["id"]).collect()}
    assert out == {"2": "not_in_set_kind,a_gt_b,too_long_name"}  # NULLs pass every rule


def test_a_first_load_joins_nothing(spark, scratch, monkeypatch):
    from shelfwise.operators import upsert as U

    at = [dt.datetime(2026, m, 5) for m in (1, 1, 2, 2)] + [None]
    batch = spark.createDataFrame([(i % 4, shop, at[i % 5]) for i, shop in zip(range(40), [3, 1, 2] * 14)] + [(None, 1, at[0])] * 2,
                                  "id bigint, shop_id int, sell_date timestamp_ntz")
    want = rows(upsert(U.empty_target(spark, S.SELL), batch, S.SELL, T0))
    assert rows(upsert(None, batch, S.SELL, T0)) == want
    assert " Join " not in merge(None, batch, S.SELL.keys, S.SELL.updates)._jdf.queryExecution().optimizedPlan().toString()
    with monkeypatch.context() as m:
        m.setattr(U, "merge", None)  # would be called
        months = upsert_months(spark, f"{scratch}/t", batch, S.SELL, T0)
    assert sorted(map(str, months)) == ["2026-01-01", "2026-02-01", "None"]
    assert rows(U.read_months(spark, f"{scratch}/t", S.SELL)) == want
    assert upsert_months(spark, f"{scratch}/none", batch.limit(0), S.SELL, T0) == []
    upsert_months(spark, f"{scratch}/t", batch.where("sell_date is not null"), S.SELL, T1)  # a second load finds the rows of the first
    assert rows(U.read_months(spark, f"{scratch}/t", S.SELL)) == want


def test_dedupe_holds_a_row_once(spark):
    from shelfwise.operators.upsert import dedupe_latest

    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "z"), (1, 2, None), (2, None, "b"), (2, None, None), (None, 5, "c")], "k int, v int, t string")
    out = dedupe_latest(df, ["k"])
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out) == [(1, 2, "a"), (2, None, "b"), (None, 5, "c")]
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 1, "z"), (2, None, "b"), (None, 5, "c")]
