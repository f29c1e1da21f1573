"""One key holding a third of the rows: results stay whole and exact, and reductions
combine map-side (partial aggregates before the exchange)."""

import random

from shelfwise.operators.upsert import dedupe_latest
from shelfwise.plans import loads as L
from shelfwise.streaming.sync import latest_by_key
from tests.test_streaming_plans import _plan


def _skewed(spark, n=30_000):
    rnd = random.Random(11)
    rows = [(1, 1, rnd.randint(1, 9)) if i % 3 == 0 else (rnd.randint(1, 20), rnd.randint(1, 500), rnd.randint(1, 9))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "shop_id int, product_id int, qty int").repartition(8)


def test_stock_sum_exact_under_hot_key(spark):
    rows, df = _skewed(spark)
    shops = spark.createDataFrame([(i,) for i in range(1, 21)], "id int")
    prods = spark.createDataFrame([(i,) for i in range(1, 501)], "id int")
    out = L.load_stock_balance(df, shops, prods)
    want = {}
    for s, p, q in rows:
        want[(s, p)] = want.get((s, p), 0) + q
    got = {(r.shop_id, r.product_id): r.qty for r in out.collect()}
    assert got == want
    plan = _plan(out)
    assert "partial_sum" in plan  # combined per task before the shuffle
    assert "BroadcastHashJoin LeftSemi" in plan  # key sets broadcast: the fact is not shuffled for them
    assert "SortMergeJoin" not in plan


def test_dedupe_and_latest_exact_under_hot_key(spark):
    rows, df = _skewed(spark)
    d = spark.createDataFrame([(s, p, q, i) for i, (s, p, q) in enumerate(rows)],
                              "shop_id int, product_id int, qty int, seq long").repartition(8)
    latest = latest_by_key(d, ["shop_id", "product_id"], "seq")
    assert latest.count() == len({(s, p) for s, p, _ in rows})
    hot = latest.where("shop_id = 1 and product_id = 1").first()
    assert hot.seq == max(i for i, (s, p, _) in enumerate(rows) if (s, p) == (1, 1))
    one = dedupe_latest(df, ["shop_id", "product_id"])
    assert one.count() == latest.count()
    assert one.where("shop_id = 1 and product_id = 1").first().qty == 9  # greatest whole row wins
