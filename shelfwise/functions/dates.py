"""Date ranges, load windows and month spines.

Everything here produces Catalyst expressions with literal bounds so that the
parquet scan receives them as ``PushedFilters`` (and, on month-partitioned
targets, as partition filters).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (  # noqa: F401
    DEFAULT_LOOKBACK_DAYS,
    END_OF_DAY,
    FULL_MODE_DEFAULT_START,
    MAX_PROBE_DAYS,
    REPAIR_DEFAULT_DAYS,
)
from .expr import month_trunc


def ts_lit(s: str) -> Column:
    """A ``timestamp_ntz`` literal (folded at plan time, pushable)."""
    return F.lit(s).cast("timestamp_ntz")


def closed_range(c, start: str | None, end: str | None) -> Column:
    """``c >= start 00:00:00 AND c <= end 23:59:59`` (the source's closed day range); None is no bound.

    The upper bound is the literal last second of ``end``; on data with
    sub-second precision ``23:59:59.5`` falls outside, as in the source.
    """
    col = F.col(c) if isinstance(c, str) else c
    low = col >= ts_lit(f"{start} 00:00:00") if start else F.lit(True)
    return low & (col <= ts_lit(f"{end} {END_OF_DAY}")) if end else low


def month_bounds(start: str, end: str) -> tuple[dt.date, dt.date]:
    s = dt.date.fromisoformat(start).replace(day=1)
    e = dt.date.fromisoformat(end).replace(day=1)
    return s, e


def month_partition_filter(start: str, end: str, month_col: str = "sell_month") -> Column:
    """Partition predicate implied by a closed day range on the month-partitioned facts."""
    s, e = month_bounds(start, end)
    return (F.col(month_col) >= F.lit(s)) & (F.col(month_col) <= F.lit(e))


def clamp_probe_days(n: int | None) -> int:
    """Probe window in days: 1..7, anything else becomes 7."""
    if n is None or n <= 0 or n > MAX_PROBE_DAYS:
        return MAX_PROBE_DAYS
    return n


def lookback(c, as_of: str, days: int) -> Column:
    """``c >= as_of - days`` (day granularity); ``as_of`` is a parameter, never the clock."""
    start = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    col = F.col(c) if isinstance(c, str) else c
    return col >= ts_lit(f"{start.isoformat()} 00:00:00")


def load_window(
    mode: str | None,
    as_of: str,
    start: str | None = None,
    end: str | None = None,
    lookback_days: int | None = DEFAULT_LOOKBACK_DAYS,
) -> tuple[str, str, str]:
    """(mode, start, end) of a batch run; a pure function of its inputs.

    daily  : as_of - N .. as_of, N <= 0 -> 7 (unknown modes become daily)
    repair : given bounds, else as_of - 7 .. as_of
    full   : given bounds, else 2026-01-01 .. as_of
    """
    today = dt.date.fromisoformat(as_of)
    mode = (mode or "daily").lower()
    if mode == "repair":
        s = start or (today - dt.timedelta(days=REPAIR_DEFAULT_DAYS)).isoformat()
        e = end or today.isoformat()
    elif mode == "full":
        s = start or FULL_MODE_DEFAULT_START
        e = end or today.isoformat()
    else:
        mode = "daily"
        n = lookback_days if lookback_days and lookback_days > 0 else DEFAULT_LOOKBACK_DAYS
        s = (today - dt.timedelta(days=n)).isoformat()
        e = today.isoformat()
    return mode, s, e


def month_spine_between(df: DataFrame, start_col: str, end_col: str, out: str = "month") -> DataFrame:
    """Explode one row per month between two columns (inclusive), per input row."""
    return df.withColumn(
        out,
        F.explode(
            F.sequence(
                F.trunc(F.col(start_col), "MM"),
                F.trunc(F.col(end_col), "MM"),
                F.expr("INTERVAL 1 MONTH"),
            )
        ),
    ).withColumn(out, F.col(out).cast("timestamp_ntz"))


def month_spine(df: DataFrame, ts_col: str) -> DataFrame:
    """Months covered by ``ts_col`` (min..max, inclusive) with the partition suffix.

    One global aggregate row, exploded: no data passes through the driver.
    """
    from .expr import partition_suffix

    bounds = df.agg(F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi"))
    spine = month_spine_between(bounds, "_lo", "_hi")
    return spine.select(
        "month",
        partition_suffix("month").alias("suffix"),
        (F.col("month") + F.expr("INTERVAL 1 MONTH")).cast("timestamp_ntz").alias("month_end"),
    )


def month_of(c) -> Column:
    return month_trunc(c)
