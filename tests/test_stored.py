"""Stored summary, key dictionaries, digests, declared constraints, late rows: what only shows over several runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import bucketed as BK
from shelfwise.operators import constraints as C
from shelfwise.operators import digest as DG
from shelfwise.operators import series as SR
from shelfwise.operators import summary as SM
from shelfwise.operators import surrogate as K
from shelfwise.operators.quality import dlq
from shelfwise.operators.upsert import conform, upsert, upsert_months
from shelfwise.streaming import sync as ST
from tests.conftest import SF_SMALL, rows
from tests.test_streaming_plans import _plan

DETAIL = "id bigint, sell_id bigint, company_id int, product_id int, shop_id int, qty int, sell_date timestamp_ntz"


def lines(n, month, first=0):
    return [(first + i, (first + i) // 2, 1, i % 3 or None, i % 2 + 1, i, dt.datetime(2026, month, 1 + i % 28)) for i in range(n)]


def files(spark, root):
    df = spark.read.parquet(root)
    return {(r[0], r[1]) for r in df.select("sell_month", F.input_file_name()).distinct().collect()}


def test_late_bill_refreshes_one_month_only(spark, scratch):
    fact, root = f"{scratch}/sell_detail", f"{scratch}/monthly"
    batch = spark.createDataFrame(lines(40, 1) + lines(30, 2, 100) + lines(20, 4, 200), DETAIL)
    upsert_months(spark, fact, batch, S.SELL_DETAIL, "2026-05-01 00:00:00")
    assert [m.month for m in SM.refresh(spark, fact, root)] == [1, 2, 4]
    assert SM.first_month(spark, root) == "2026-01-01"
    before = files(spark, f"{root}/sales")
    assert SM.refresh(spark, fact, root) == []  # nothing has changed

    late = spark.createDataFrame([(999, 999, 1, 2, 1, 50, dt.datetime(2026, 2, 14))], DETAIL)
    touched = upsert_months(spark, fact, late, S.SELL_DETAIL, "2026-05-02 00:00:00")
    assert SM.refresh(spark, fact, root, touched) == [dt.date(2026, 2, 1)]
    after = files(spark, f"{root}/sales")
    assert {f for f in before if f[0].month != 2} == {f for f in after if f[0].month != 2}
    want = SR.monthly(spark.read.parquet(fact), list(SM.KEYS))
    assert rows(SM.read(spark, root), *want.columns) == rows(want)

    # A changed line that keeps the month's row count and total is seen as well.
    swap = spark.createDataFrame([(101, 50, 1, 2, 1, 1, dt.datetime(2026, 2, 2))], DETAIL)
    upsert_months(spark, fact, swap, S.SELL_DETAIL, "2026-05-03 00:00:00")
    assert [m.month for m in SM.refresh(spark, fact, root)] == [2]


def test_a_month_without_rows_is_emptied(spark, scratch):
    root = f"{scratch}/monthly"
    spark.createDataFrame(lines(9, 1) + lines(9, 3, 50), DETAIL).withColumn("sell_month", F.to_date(F.trunc("sell_date", "MM"))).write.partitionBy("sell_month").parquet(f"{scratch}/a")
    spark.createDataFrame(lines(9, 1), DETAIL).withColumn("sell_month", F.to_date(F.trunc("sell_date", "MM"))).write.partitionBy("sell_month").parquet(f"{scratch}/b")
    SM.refresh(spark, f"{scratch}/a", root)
    assert [m.month for m in SM.refresh(spark, f"{scratch}/b", root)] == [3]
    assert {r.month.month for r in SM.read(spark, root).collect()} == {1}
    assert SM.refresh(spark, f"{scratch}/b", root) == []


def test_summary_tells_bills_apart_in_parts_of_bounded_size(spark, scratch, monkeypatch):
    batch = spark.createDataFrame(lines(400, 1) + lines(300, 2, 1000) + [(5000 + i, i, 1, 1, 1, 1, dt.datetime(2026, 3, 3)) for i in range(300)], DETAIL)
    upsert_months(spark, f"{scratch}/sell_detail", batch, S.SELL_DETAIL, "2026-05-01 00:00:00")
    made = []
    monkeypatch.setattr(SM, "LINES_PER_TASK", 70)
    monkeypatch.setattr(SM, "monthly", lambda *a, **k: made.append(SR.monthly(*a, **k)) or made[-1])
    assert len(SM.refresh(spark, f"{scratch}/sell_detail", f"{scratch}/monthly")) == 3
    parts = [x for x in _plan(made[0]).splitlines() if "REPARTITION_BY_NUM" in x]
    assert parts and all(", 15)" in x for x in parts)  # 1000 lines, by key, month and bill
    want = SR.monthly(spark.read.parquet(f"{scratch}/sell_detail"), list(SM.KEYS))
    assert rows(SM.read(spark, f"{scratch}/monthly"), *want.columns) == rows(want)
    assert [SM._parts(n) for n in (0, 70, 71, 10**12)] == [1, 1, 2, SM.MAX_TASKS]


@pytest.mark.parametrize("name", ["sales_trend", "sales_yearly_agg", "sales_summary", "forecast_compare", "calculate_reorder", "sales_monthly_by_shop"])
def test_planning_reads_the_summary_not_the_detail(spark, name):
    import __spark_entry__ as E

    txt = _plan(E.queries()[name](spark, SF_SMALL))
    assert "/monthly/sales" in txt
    assert "lineitem" not in txt and "/sell_detail" not in txt and "orders.parquet" not in txt


def test_lookups_prune_the_written_months(spark):
    import __spark_entry__ as E

    for name in ("get_sells_by_range", "get_details_by_sell", "true_sell_windows"):
        txt = _plan(E.queries()[name](spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(sell_month" in txt and "lineitem" not in txt, name


# --- bucketed facts


def sells(ids, shop, year=2026):
    return [(i, shop, i is not None and dt.datetime(year, 1 + i % 3, 1 + i % 28) or dt.datetime(year, 2, 3)) for i in ids]


SELLS = "id bigint, shop_id int, sell_date timestamp_ntz"
EARLY, LATE = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def test_bucketed_upsert_equals_merge(spark, scratch):
    old = spark.createDataFrame(sells([*range(300), None], 1), SELLS)
    new = spark.createDataFrame(sells([i for i in range(200, 400) if i % 3 != 2] + [None, None], 2) + sells([201, 201], 7), SELLS)
    root = f"{scratch}/sell"
    assert len(BK.upsert_fact(spark, root, old, S.SELL, EARLY, buckets=4)) == 3
    before = files(spark, root)
    assert {m.month for m in BK.upsert_fact(spark, root, new, S.SELL, LATE, buckets=9)} == {1, 2}
    want = upsert(conform(old, S.SELL, EARLY), new, S.SELL, LATE)
    got = BK.read_fact(spark, root, S.SELL)
    assert rows(got, *S.SELL.columns) == rows(want)
    assert {f for f in before if f[0].month == 3} == {f for f in files(spark, root) if f[0].month == 3}  # not rewritten
    for _ in range(2):
        BK.upsert_fact(spark, root, new, S.SELL, LATE)
    assert rows(BK.read_fact(spark, root, S.SELL), *S.SELL.columns) == rows(want)
    # A new session finds the table by its place, with the buckets it was made with.
    name = BK.open_table(spark, root, S.SELL)
    spark.sql(f"DROP TABLE {name}")
    assert rows(BK.read_fact(spark, root, S.SELL), *S.SELL.columns) == rows(want) and BK._buckets_of(spark, name) == 4
    assert BK.upsert_fact(spark, root, new.limit(0), S.SELL, LATE) == []


def test_upsert_does_not_shuffle_the_target(spark, scratch):
    root = f"{scratch}/sell"
    BK.upsert_fact(spark, root, spark.createDataFrame(sells(range(300), 1), SELLS), S.SELL, EARLY, buckets=4)
    new = conform(spark.createDataFrame(sells(range(100), 2), SELLS), S.SELL, LATE)
    plan = _plan(BK.merge_bucketed(BK.read_fact(spark, root, S.SELL), new, S.SELL, 4))
    main = plan[: plan.index("(1) ")].split("SortMergeJoin FullOuter")[1]
    target = main[: main.index("Scan parquet")]  # what stands between the join and the target's scan
    assert "Exchange" not in target and "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_bucketed_upsert_keeps_other_months_in_a_session_of_static_overwrites(spark, scratch):
    mode = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(mode)
    spark.conf.set(mode, "static")  # Spark's default
    try:
        root = f"{scratch}/sell"
        BK.upsert_fact(spark, root, spark.createDataFrame(sells(range(60), 1), SELLS), S.SELL, EARLY, buckets=2)
        new = spark.createDataFrame(sells([i for i in range(40, 80) if i % 3 == 1], 2), SELLS)
        assert BK.upsert_fact(spark, root, new, S.SELL, LATE) == [dt.date(2026, 2, 1)]
        got = {r.id: r.shop_id for r in BK.read_fact(spark, root, S.SELL).collect()}
    finally:
        spark.conf.set(mode, was)
    assert got == {i: 2 if i % 3 == 1 and i >= 40 else 1 for i in range(80) if i < 60 or i % 3 == 1}


def test_a_bucketed_table_of_an_older_release_is_declared_anew(spark, scratch):
    root = f"{scratch}/sell"
    BK.upsert_fact(spark, root, spark.createDataFrame(sells(range(30), 1), SELLS), S.SELL, EARLY, buckets=2)
    name = BK.open_table(spark, root, S.SELL)
    made = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    spark.sql(f"DROP TABLE {name}")
    spark.sql("\n".join(line for line in made.replace("OPTIONS (\n  'partitionOverwriteMode' = 'dynamic')\n", "").split("\n")))
    assert not BK._is_dynamic(spark, name)
    assert BK.read_fact(spark, root, S.SELL).count() == 30 and BK._is_dynamic(spark, name)


def test_buckets_follow_the_busiest_month():
    assert [BK.buckets_for(x << 20) for x in (0, 256, 257, 2560)] == [1, 1, 2, 10]


# --- digests


ROW = "id bigint, shop_id int, note string, sell_date timestamp_ntz"


def bills(n):
    return [(i if i else None, i % 5 or None, None if i % 7 else "x", dt.datetime(2026, 1 + i % 4, 1 + i % 28) if i % 11 else None) for i in range(n)]


def test_descent_names_lost_added_changed_and_doubled_rows(spark):
    data = bills(400)
    bad = [list(r) for r in data]
    bad[9][1], bad[9][2] = None, None
    bad[20] = [20, None, "0", bad[20][3]]
    lost, doubled = bad.pop(300), bad[42]
    bad += [doubled, [5000, 1, "new", dt.datetime(2026, 2, 2)]]
    a, b = spark.createDataFrame(data, ROW).repartition(5), spark.createDataFrame(bad, ROW).repartition(3)
    columns = ["id", "shop_id", "note", "sell_date"]
    want = [(9, "changed", 1, 1), (20, "changed", 1, 1), (42, "doubled", 1, 2), (300, "lost", 1, 0), (5000, "added", 0, 1)]
    assert lost[0] == 300
    for levels in (DG.month_levels("sell_date", None), DG.hash_levels(["id"])):
        got = DG.descend(a, b, ["id"], columns, levels)
        assert sorted(map(tuple, got.collect())) == want
        assert DG.descend(a, a.repartition(2), ["id"], columns, levels).count() == 0


def test_descent_reads_only_differing_months(spark, scratch):
    data = bills(300)
    full = spark.createDataFrame(data, ROW).where("sell_date is not null")
    full.withColumn("sell_month", F.to_date(F.trunc("sell_date", "MM"))).where("id != 21").write.partitionBy("sell_month").parquet(f"{scratch}/t")
    target = spark.read.parquet(f"{scratch}/t")
    got = DG.descend(full, target, ["id"], ["id", "shop_id", "sell_date"], DG.month_levels("sell_date"))
    assert [tuple(r) for r in got.collect()] == [(21, "lost", 1, 0)]
    assert "PartitionFilters" in _plan(got) and "2026-02-01" in _plan(got)


def test_null_in_one_column_differs_from_null_in_another(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert df.select(DG.row_hash(["a", "b"])).distinct().count() == 2


# --- key dictionaries


def test_dictionary_keeps_ids_and_never_merges_texts(spark, scratch, monkeypatch):
    first = spark.createDataFrame([(f"type {i % 50}",) for i in range(200)] + [(None,), ("",)], "t string")
    got = {r.key: r.id for r in K.extend(spark, f"{scratch}/k", first).collect()}
    texts = sorted({f"type {i}" for i in range(50)} | {""})
    assert got == {t: i for i, t in enumerate(texts, 1)}
    again = {r.key: r.id for r in K.extend(spark, f"{scratch}/k", first.repartition(7)).collect()}
    assert again == got
    more = spark.createDataFrame([("a new one",), ("type 3",), ("Another",)], "t string")
    grown = {r.key: r.id for r in K.extend(spark, f"{scratch}/k", more).collect()}
    assert grown == got | {"Another": 52, "a new one": 53}
    with pytest.raises(ValueError, match="one to one"):
        K.check(spark.createDataFrame([("a", 1), ("b", 1)], "k string, id int"), "k", "id")


def test_ids_do_not_depend_on_partitions(spark):
    keys = spark.createDataFrame([(f"k{i:04d}",) for i in range(500)], "key string")
    for n in (1, 3, 40):
        got = {r.key: r.id for r in K.numbered(keys.repartition(5), 10, n).collect()}
        assert got == {f"k{i:04d}": 11 + i for i in range(500)}


def test_empty_dictionary(spark, scratch):
    assert K.extend(spark, f"{scratch}/k", spark.createDataFrame([], "t string")).count() == 0


# --- declared constraints


def test_every_declared_rule_is_checked(spark):
    assert set(S.CONSTRAINTS) == set(S.TARGETS)
    assert sum(len(c.references) for c in S.CONSTRAINTS.values()) == 16
    for name, rules in S.CONSTRAINTS.items():
        assert {*rules.not_null, *rules.lengths, *rules.references} <= set(S.TARGETS[name].columns)


def test_violations_are_reported_and_set_aside(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    parents = {t: ids for t in S.TARGETS}
    df = spark.createDataFrame(
        [(1, "a", 1, 1, 1, 1, "ok", "ACTIVE"), (2, "b" * 51, 9, None, 1, 9, "ok", "ACTIVE"), (3, None, 1, 1, 1, 1, None, None), (3, "c", 2, 2, 2, 2, "ok", "x" * 51)],
        "id int, pu_product_id string, brand_id int, category_id int, group_id int, type_id int, description string, status string")
    got = {(r.rule, r.column_name): r.n_rows for r in C.report(df, "products", parents).collect()}
    assert got == {
        ("not_null", "id"): 0, ("not_null", "description"): 1, ("length", "pu_product_id"): 1, ("length", "status"): 1,
        ("foreign_key", "brand_id"): 1, ("foreign_key", "category_id"): 0, ("foreign_key", "group_id"): 0, ("foreign_key", "type_id"): 1,
        ("unique", "id"): 1,
    }
    letters = dlq(C.rejects(df, "products", parents), "products", ["id"])
    assert rows(letters, "row_key", "reason") == [
        ("2", "length_pu_product_id,foreign_key_brand_id,foreign_key_type_id"), ("3", "length_status"), ("3", "not_null_description")]


# --- streams


def test_null_and_tied_sequences(spark, scratch):
    data = [(1, "a", None), (1, "b", 2), (2, "x", 5), (2, "y", 5), (3, "only", None)]
    df = spark.createDataFrame(data, "k int, v string, seq int")
    for part in (1, 4):
        assert rows(ST.latest_by_key(df.repartition(part), ["k"], "seq")) == [(1, "b", 2), (2, "y", 5), (3, "only", None)]
    src = f"{scratch}/in"
    df.write.parquet(src)
    root, letters = f"{scratch}/out", f"{scratch}/dlq"
    for _ in range(2):  # a restart adds nothing
        ST.stream_delta_sync(spark, ST.file_stream(spark, src, df.schema), lambda b: b, root, ["k"], "seq", df.limit(0), buckets=4, dlq_root=letters)
    assert rows(ST.read_bucketed(spark, root, df)) == [(1, "b", 2), (2, "y", 5)]
    assert rows(spark.read.parquet(letters), "row_key", "reason") == [("1", "no_seq"), ("3", "no_seq")]


def test_rows_past_the_watermark_reach_the_dead_letters(spark, scratch):
    src, out, letters = f"{scratch}/in", f"{scratch}/out", f"{scratch}/dlq"
    schema = "id int, ts timestamp_ntz, v int"

    def arrive(*given):
        spark.createDataFrame([(i, ts and dt.datetime(2026, *ts), i) for i, ts in given], schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        events = ST.file_stream(spark, src, spark.createDataFrame([], schema).schema, max_files=1)
        ST.stream_late_data(spark, events, out, "ts", ["id"], delay="7 days")
        ST.stream_late_rejects(spark, events, out, letters, "ts", ["id"])

    arrive(*[(i, (3, i)) for i in range(1, 20)])
    arrive((30, (3, 25)), (5, (3, 5)))
    arrive((31, (1, 1)), (32, (3, 24)), (30, (3, 25)))
    run()
    arrive((33, (2, 1)), (34, None), (35, (3, 26)))
    run()
    run()
    kept = {r.id for r in spark.read.parquet(out).collect()}
    away = {r.row_key: r.reason for r in spark.read.parquet(letters).collect()}
    assert kept == {*range(1, 20), 30, 32, 35}
    assert away == {"31": "past_watermark", "33": "past_watermark", "34": "no_ts"}
    read = {r.id for r in spark.read.parquet(src).collect()}
    assert read == kept | {int(k) for k in away}
