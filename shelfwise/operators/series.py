"""Sales series: monthly / yearly summaries, dense calendars, trends, roll-ups.

Every series is aggregated to (keys, month) *before* any window runs, so a hot
shop or product is combined map-side by the partial aggregate and windows
only ever see one row per month per key (bounded by the calendar length).
Dense calendars are generated per key from ``sequence`` — never a cross join
of all keys with all months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import closed_range
from ..functions.expr import month_trunc, year_trunc
from .keys import bounded_broadcast, known_rows

PRODUCT_DIMS = ("brand_id", "category_id", "group_id", "type_id")


def sales_fact(detail: DataFrame, products: DataFrame, dims: Sequence[str] = PRODUCT_DIMS) -> DataFrame:
    """Detail rows with their product's dimension ids (size-checked broadcast of products)."""
    p = products.select(F.col("id").alias("_pid"), *dims)
    b = bounded_broadcast(p, upper_bound=known_rows(products))
    return detail.join(b, detail["product_id"] == F.col("_pid"), "left").drop("_pid")


def sales_filtered(fact: DataFrame, filters: Mapping[str, Sequence | None]) -> DataFrame:
    """Conjunctive optional filters: ``{"shop_id": [1, 2], "brand_id": None, ...}``.

    ``None`` or an empty list means "no filter" on that attribute.
    """
    out = fact
    for col, values in filters.items():
        if values:
            out = out.where(F.col(col).isin(list(values)))
    return out


def monthly(fact: DataFrame, keys: Sequence[str], date_col: str = "sell_date", partitions: int | None = None) -> DataFrame:
    """(keys, month) -> qty, n_bills, n_lines.

    ``partitions`` deals the lines by key, month and bill first: bills are then told apart in
    parts of the size that the caller chose (hot keys are spread by bill), without another shuffle.
    """
    lines = fact.select(*keys, month_trunc(date_col).alias("month"), "sell_id", "qty")
    if partitions:
        lines = lines.repartition(partitions, *keys, "month", "sell_id")
    return (
        lines.groupBy(*keys, "month")
        .agg(
            F.sum("qty").alias("qty"),
            F.countDistinct("sell_id").alias("n_bills"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


def yearly_from_monthly(mon: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Yearly totals re-aggregated from the monthly table.

    All three measures are additive across months (a bill has one date, so it
    falls in exactly one month).
    """
    return (
        mon.withColumn("year", year_trunc("month"))
        .groupBy(*keys, "year")
        .agg(F.sum("qty").alias("qty"), F.sum("n_bills").alias("n_bills"), F.sum("n_lines").alias("n_lines"))
    )


def dense_monthly(
    mon: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    value: str = "qty",
) -> DataFrame:
    """Zero-filled monthly series for every key present, months ``start..end`` (from the data's first month on, as a rule).

    One shuffle by key: each key's months are collected into a map (bounded by
    the calendar length), then the calendar is exploded from ``sequence``.
    """
    per_key = mon.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("month"), F.col(value)))).alias("_m")
    )
    cal = F.sequence(
        F.trunc(F.lit(start).cast("date"), "MM"),
        F.trunc(F.lit(end).cast("date"), "MM"),
        F.expr("INTERVAL 1 MONTH"),
    )
    dense = per_key.select(*keys, "_m", F.explode(cal).alias("_d"))
    dense = dense.withColumn("month", F.col("_d").cast("timestamp_ntz"))
    return dense.select(
        *keys, "month", F.coalesce(F.element_at("_m", F.col("month")), F.lit(0)).cast("bigint").alias(value)
    )


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev as DOUBLE; NULL when prev is 0 or NULL."""
    return F.try_divide((cur - prev).cast("double"), prev.cast("double"))


def sales_trend(dense: DataFrame, keys: Sequence[str], value: str = "qty") -> DataFrame:
    """Month-over-month and year-over-year change on a dense monthly series."""
    w = Window.partitionBy(*keys).orderBy("month")
    prev_m = F.lag(value, 1).over(w)
    prev_y = F.lag(value, 12).over(w)
    return dense.select(
        *keys,
        "month",
        F.col(value),
        prev_m.alias("prev_month_qty"),
        prev_y.alias("prev_year_qty"),
        F.round(pct_change(F.col(value), prev_m), 6).alias("mom_pct"),
        F.round(pct_change(F.col(value), prev_y), 6).alias("yoy_pct"),
    )


def sales_summary(sums: DataFrame, a: str = "shop_id", b: str = "group_id") -> DataFrame:
    """Totals by (a, b) with subtotals per a and a grand total.

    ``sums`` has qty and n_lines; they are summed by (a, b) first, so the ROLLUP
    expands these few rows and not every line.
    """
    pair = sums.groupBy(a, b).agg(F.sum("qty").alias("qty"), F.sum("n_lines").alias("n_lines"))
    return pair.rollup(a, b).agg(
        F.sum("qty").alias("qty"),
        F.sum("n_lines").alias("n_lines"),
        F.grouping_id(a, b).cast("int").alias("level"),
    )


def touched_range(start: str, end: str) -> tuple[str, str]:
    """The whole months that a closed day window touches, as a closed day range."""
    from ..functions.dates import month_bounds

    lo, hi = month_bounds(start, end)
    after = (hi.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return str(lo), str(after - dt.timedelta(days=1))


def agg_incremental(
    current: DataFrame,
    fact: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    date_col: str = "sell_date",
) -> DataFrame:
    """Upkeep of a monthly summary after a reload of the window ``start..end``.

    Every month the window touches is summed anew from ``fact``, which must
    hold all rows of these months (``touched_range``), also those before a window that
    starts mid-month; a month found empty is emptied; other months keep their
    stored totals. The touched months are known from the window, so keeping
    the rest is a plain (prunable) filter, not a join. Equal to a full rebuild.
    """
    lo, hi = touched_range(start, end)
    m = F.col("month")
    outside = (m < F.lit(lo).cast("timestamp_ntz")) | (m > F.lit(hi).cast("timestamp_ntz"))
    new = monthly(fact.where(closed_range(date_col, lo, hi)), keys, date_col)
    return current.where(outside).unionByName(new)
