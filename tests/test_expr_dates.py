"""Cleansing expressions (Q1-Q5), date keys and window rules (Q11, load_window)."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.functions import expr as X


def test_default_if_empty_and_flags(spark):
    df = spark.createDataFrame(
        [(1, "", None, "Y"), (2, None, "x", None), (3, "INACTIVE", "", "N")],
        "id int, status string, descr string, active string",
    )
    out = df.select(
        "id",
        X.default_if_empty("status", "ACTIVE").alias("status"),
        X.default_if_empty("descr", "Unspecified Product").alias("descr"),
        X.flag_to_bool("active").alias("is_active"),
        X.empty_if_null("descr").alias("descr0"),
    ).orderBy("id").collect()
    assert [r.status for r in out] == ["ACTIVE", "ACTIVE", "INACTIVE"]  # Q1: '' and NULL
    assert [r.descr for r in out] == ["Unspecified Product", "x", "Unspecified Product"]  # Q2
    assert [r.is_active for r in out] == [True, False, False]  # Q3: NULL -> false, never NULL
    assert [r.descr0 for r in out] == ["", "x", ""]  # Q5


def test_positive_guard_rejects_null_and_zero(spark):
    df = spark.createDataFrame([(1, 2), (0, 2), (None, 3), (4, -1)], "a int, b int")
    assert df.where(X.positive("a", "b")).count() == 1


def test_text_keys_and_suffix(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 8, 3, 10, 0), "Blue RING")], "ts timestamp_ntz, name string")
    r = df.select(
        X.date_text_key("ts", "yyyyMMdd").alias("d"),
        X.date_text_key("ts", "MMyyyy").alias("m"),
        X.partition_suffix("ts").alias("p"),
        X.suffix_match("name", "ring").alias("hit"),
        X.month_trunc("ts").alias("mt"),
    ).first()
    assert (r.d, r.m, r.p, r.hit) == ("20260803", "082026", "y2026m08", True)
    assert r.mt == dt.datetime(2026, 8, 1)


def test_closed_range_includes_last_second_only(spark):
    # Q11: the upper bound is the literal 23:59:59 of the end day.
    df = spark.createDataFrame(
        [
            (1, dt.datetime(2026, 1, 1, 0, 0, 0)),
            (2, dt.datetime(2026, 1, 31, 23, 59, 59)),
            (3, dt.datetime(2026, 1, 31, 23, 59, 59, 500000)),
            (4, dt.datetime(2025, 12, 31, 23, 59, 59)),
        ],
        "id int, ts timestamp_ntz",
    )
    got = sorted(r.id for r in df.where(D.closed_range("ts", "2026-01-01", "2026-01-31")).collect())
    assert got == [1, 2]


def test_load_window_rules():
    assert D.load_window("daily", "2026-03-10", lookback_days=3) == ("daily", "2026-03-07", "2026-03-10")
    assert D.load_window("daily", "2026-03-10", lookback_days=0) == ("daily", "2026-03-03", "2026-03-10")
    assert D.load_window("repair", "2026-03-10") == ("repair", "2026-03-03", "2026-03-10")
    assert D.load_window("repair", "2026-03-10", "2026-01-01", "2026-01-31") == ("repair", "2026-01-01", "2026-01-31")
    assert D.load_window("full", "2026-03-10") == ("full", "2026-01-01", "2026-03-10")
    assert D.load_window("nonsense", "2026-03-10", lookback_days=2)[0] == "daily"
    assert [D.clamp_probe_days(n) for n in (None, 0, 3, 7, 8, 30)] == [7, 7, 3, 7, 7, 7]


def test_month_spine_from_data(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 11, 15),), (dt.datetime(2026, 2, 1),)], "ts timestamp_ntz")
    sp = D.month_spine(df, "ts").orderBy("month").collect()
    assert [r.suffix for r in sp] == ["y2025m11", "y2025m12", "y2026m01", "y2026m02"]
    assert sp[0].month_end == dt.datetime(2025, 12, 1)


def test_lookback_is_parameterised(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 2),), (dt.datetime(2026, 3, 3),)], "ts timestamp_ntz")
    assert df.where(D.lookback("ts", "2026-03-10", 7)).count() == 1
    assert df.where(F.lit(True)).count() == 2
