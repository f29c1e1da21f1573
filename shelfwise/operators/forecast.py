"""Forecasts on dense monthly series: SMA, WAG, same-month YoY, and a back-test.

Definitions (the planning notes name the methods, not their formulas):

* ``pct``   = (q - q_prev) / q_prev, NULL when q_prev is 0 or missing.
* SMA       = mean of the last ``n`` pct values (NULLs skipped); forecast = q * (1 + sma).
* WAG       = sum(w_i * pct_i) / sum(w_i) over the last ``n`` non-NULL pct,
              weights n..1 from newest to oldest; forecast = q * (1 + wag).
* YoY       = growth of the same calendar month year over year, averaged over
              the last ``years`` years; estimate = q * (1 + growth_avg) for
              the same month next year, and the plain ``years``-year average.

On a dense calendar "the same month last year" is ``lag(q, 12)``, so every
method — and the back-test's ``lead`` actuals — is computed by ONE window
operator over one shuffle by the series key (``forecast_table``). Each key
holds one row per month, so a window partition is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import pct_change


def _w(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("month")


def _mean_of(cols: list[Column]) -> Column:
    """Mean of the non-NULL columns (NULL if all are NULL), summed oldest first."""
    total = None
    count = None
    for c in cols:
        v = F.coalesce(c, F.lit(0.0))
        n = F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = v if total is None else total + v
        count = n if count is None else count + n
    return F.when(count > 0, total / count)


def forecast_table(dense: DataFrame, keys: Sequence[str], n: int = 3, years: int = 5, value: str = "qty") -> DataFrame:
    """All three methods for every (key, month) from a single window pass."""
    w = _w(keys)
    q = F.col(value)
    base = dense.withColumn("pct", pct_change(q, F.lag(value, 1).over(w))).withColumn(
        "growth", pct_change(q, F.lag(value, 12).over(w))
    )
    lags = [(n - i, F.lag("pct", i).over(w) if i else F.col("pct")) for i in range(n)]
    num = sum((F.coalesce(c * wt, F.lit(0.0)) for wt, c in lags), F.lit(0.0))
    den = sum((F.when(c.isNotNull(), F.lit(float(wt))).otherwise(F.lit(0.0)) for wt, c in lags), F.lit(0.0))
    same_month = list(range(years - 1, -1, -1))  # oldest year first
    out = base.select(
        *keys, "month", q,
        F.col("pct"),
        F.avg("pct").over(w.rowsBetween(-(n - 1), 0)).alias("sma"),
        F.try_divide(num, F.nullif(den, F.lit(0.0))).alias("wag"),
        F.col("growth"),
        _mean_of([F.lag("growth", 12 * k).over(w) if k else F.col("growth") for k in same_month]).alias("growth_avg"),
        _mean_of([F.lag(value, 12 * k).over(w).cast("double") if k else q.cast("double") for k in same_month]).alias(
            "avg_qty"),
        F.lead(value, 1).over(w).alias("next_month_qty"),
        F.lead(value, 12).over(w).alias("next_year_qty"),
    )
    return out.select(
        *keys, "month", value,
        F.round("pct", 6).alias("pct"),
        F.round("sma", 6).alias("sma"),
        F.round(q * (1 + F.col("sma")), 6).alias("forecast_sma"),
        F.round("wag", 6).alias("wag"),
        F.round(q * (1 + F.col("wag")), 6).alias("forecast_wag"),
        F.round("growth", 6).alias("growth"),
        F.round("growth_avg", 6).alias("growth_avg"),
        F.round("avg_qty", 6).alias("avg_qty"),
        F.round(q * (1 + F.col("growth_avg")), 6).alias("estimate"),
        "next_month_qty",
        "next_year_qty",
    )


def forecast_sma(dense: DataFrame, keys: Sequence[str], n: int = 3, value: str = "qty") -> DataFrame:
    """Moving average of month-over-month change and the next-month forecast."""
    t = forecast_table(dense, keys, n, value=value)
    return t.select(*keys, "month", value, "pct", "sma", F.col("forecast_sma").alias("forecast"))


def forecast_wag(dense: DataFrame, keys: Sequence[str], n: int = 3, value: str = "qty") -> DataFrame:
    """Weighted average growth (newest weight n) and the next-month forecast."""
    t = forecast_table(dense, keys, n, value=value)
    return t.select(*keys, "month", value, "pct", "wag", F.col("forecast_wag").alias("forecast"))


def forecast_yoy(dense: DataFrame, keys: Sequence[str], years: int = 5, value: str = "qty") -> DataFrame:
    """Same-month growth averaged over ``years`` years, and the estimate for next year."""
    t = forecast_table(dense, keys, years=years, value=value)
    return t.select(*keys, "month", value, "growth", "growth_avg", "avg_qty", "estimate")


def forecast_compare(
    dense: DataFrame, keys: Sequence[str], n: int = 3, years: int = 5, value: str = "qty"
) -> DataFrame:
    """Back-test of the three methods: MAE and MAPE per key and method, ranked by MAE.

    SMA and WAG forecast the next month (actual = ``lead(q, 1)``); YoY forecasts
    the same month next year (actual = ``lead(q, 12)``). MAPE skips zero actuals.
    """
    t = forecast_table(dense, keys, n, years, value)
    long = t.select(
        *keys,
        F.expr(
            "stack(3, 'SMA', forecast_sma, next_month_qty, 'WAG', forecast_wag, next_month_qty, "
            "'YOY', estimate, next_year_qty) as (method, forecast, actual)"
        ),
    ).where(F.col("forecast").isNotNull() & F.col("actual").isNotNull())
    err = F.abs(F.col("forecast") - F.col("actual"))
    # Forecasts carry 6 decimals: summing errors in integer micro-units keeps MAE exact.
    micro = F.round(err * 1_000_000).cast("bigint")
    agg = long.groupBy(*keys, "method").agg(
        F.round(F.sum(micro) / F.count(F.lit(1)) / 1_000_000.0, 6).alias("mae"),
        F.round(F.avg(F.when(F.col("actual") != 0, err / F.col("actual"))), 6).alias("mape"),
        F.count(F.lit(1)).alias("n_points"),
    )
    rk = Window.partitionBy(*keys).orderBy(F.col("mae").asc_nulls_last(), "method")
    return agg.withColumn("rank", F.rank().over(rk).cast("int"))
