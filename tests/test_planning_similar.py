"""Planning operators against brute force on small fixtures; exact similarity search."""

import random

import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import planning as PL
from shelfwise.operators import similar as SIM


def _brute_rebalance(stock, need):
    out = {}
    prods = {p for (_, p) in stock} | {p for (_, p) in need}
    for p in prods:
        shops = sorted({s for (s, q) in stock if q == p} | {s for (s, q) in need if q == p})
        sur, dfc = [], []
        for s in shops:
            v = stock.get((s, p), 0.0) - need.get((s, p), 0.0)
            if v > 0:
                sur.append((s, v))
            elif v < 0:
                dfc.append((s, -v))
        i = j = 0
        sur = [list(x) for x in sur]
        dfc = [list(x) for x in dfc]
        while i < len(sur) and j < len(dfc):
            t = min(sur[i][1], dfc[j][1])
            out[(p, sur[i][0], dfc[j][0])] = out.get((p, sur[i][0], dfc[j][0]), 0.0) + t
            sur[i][1] -= t
            dfc[j][1] -= t
            if sur[i][1] == 0:
                i += 1
            if dfc[j][1] == 0:
                j += 1
    return {k: round(v, 6) for k, v in out.items() if v > 0}


def test_rebalance_matches_greedy_brute_force(spark):
    rnd = random.Random(7)
    for _ in range(3):
        stock = {(s, p): float(rnd.randint(0, 9)) for s in range(1, 7) for p in range(1, 4) if rnd.random() < 0.7}
        need = {(s, p): float(rnd.randint(0, 9)) for s in range(1, 7) for p in range(1, 4) if rnd.random() < 0.7}
        sdf = spark.createDataFrame([(s, p, int(q)) for (s, p), q in stock.items()], "shop_id int, product_id int, qty int")
        ndf = spark.createDataFrame([(s, p, q) for (s, p), q in need.items()],
                                    "shop_id int, product_id int, truesell_qty_30_day double")
        got = {(r.product_id, r.from_shop, r.to_shop): r.transfer_qty for r in PL.rebalance_stock(sdf, ndf).collect()}
        assert got == _brute_rebalance(stock, need)


def test_orders_recommend_and_proposal(spark):
    reorder = spark.createDataFrame(
        [(1, g, "WAG", 10.0, float(o)) for g, o in [(1, 5), (2, -3), (3, 12), (4, 7)]],
        "shop_id int, group_id int, method string, forecast double, order_qty double",
    )
    rec = PL.recommend_purchase(reorder, "WAG", 10.0, 2).orderBy("rank").collect()
    assert [(r.group_id, r.recommended_qty) for r in rec] == [(3, 14), (4, 8)]  # ceil(12*1.1)=14, ceil(7.7)=8
    prop = PL.purchase_proposal(PL.recommend_purchase(reorder, "WAG", 10.0, 2), "2026-08-01")
    r = prop.withColumn("txt", PL.proposal_text(F.col("lines"))).first()
    assert (r.txt, r.n_lines, r.total_qty, r.status) == ("3:14;4:8", 2, 22, "proposed")


def test_low_and_over_stock(spark):
    sg = spark.createDataFrame([(1, 1, 3), (1, 2, 50), (1, 3, 10)], "shop_id int, group_id int, current_stock bigint")
    tg = spark.createDataFrame([(1, 1, 5.0, 20.0, 1.0, 0.0), (1, 2, 5.0, 20.0, 1.0, 0.0)],
                               "shop_id int, product_group_id int, min_qty double, max_qty double, "
                               "sell_multiply double, show_qty double")
    assert [r.group_id for r in PL.low_stock(sg, tg).collect()] == [1]
    assert [r.group_id for r in PL.overstock(sg, tg).collect()] == [2]


def test_similar_products_exact_and_chunked(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(60, 8)).astype(np.float32)
    cat = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                "id long, embedding array<float>").repartition(4)
    qids = [0, 7, 19, 33, 41]
    queries = cat.where(F.col("id").isin(qids)).select(F.col("id").alias("query_id"), "embedding")
    got = SIM.similar_products(cat, queries, k=4)
    chunked = SIM.similar_products(cat, queries, k=4, max_query_rows=2)
    v = vecs.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = set()
    for q in qids:
        s = v @ v[q]
        s[q] = -np.inf
        order = sorted(range(len(s)), key=lambda i: (-round(s[i], 9), i))[:4]
        want |= {(q, r + 1, i) for r, i in enumerate(order)}
    assert {(r.query_id, r.rank, r.id) for r in got.collect()} == want
    assert {(r.query_id, r.rank, r.id) for r in chunked.collect()} == want
