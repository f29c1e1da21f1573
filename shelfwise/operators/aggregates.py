"""Small aggregate operators: probes, load counts, observed metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import ACTIVE_FLAG, STATUS_ACTIVE
from ..functions.dates import clamp_probe_days, lookback


def count_probe(shops: DataFrame, products: DataFrame, sells: DataFrame, as_of: str, days: int | None) -> DataFrame:
    """Three filtered counts: active shops, active products, sales in the (clamped) window.

    Each is a global count (partial counts per task, one tiny final merge).
    """
    n = clamp_probe_days(days)
    parts = [
        shops.where(F.col("active") == ACTIVE_FLAG).agg(F.count(F.lit(1)).alias("n")).select(F.lit("active_shops").alias("probe"), "n"),
        products.where(F.col("status") == STATUS_ACTIVE).agg(F.count(F.lit(1)).alias("n")).select(F.lit("active_products").alias("probe"), "n"),
        sells.where(lookback("sell_date", as_of, n)).agg(F.count(F.lit(1)).alias("n")).select(F.lit("recent_sales").alias("probe"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table_name, n_rows)``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def content_text(field: T.StructField) -> Column:
    """A value as text that any engine writes alike: whole units of 1/10000 for doubles, digits for times."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        c = F.round(c * 10000).cast("bigint")
    elif isinstance(field.dataType, T.TimestampNTZType):
        c = F.date_format(c, "yyyyMMddHHmmss")
    return F.coalesce(c.cast("string"), F.lit("~"))


def content_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table_name, n_rows, content)``; ``content`` adds up a checksum of every row's values."""
    parts = []
    for name, df in tables.items():
        text = F.concat_ws("|", *[content_text(f) for f in df.schema.fields])
        check = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(check), F.lit(0)).cast("bigint").alias("content"))
        parts.append(one.select(F.lit(name).alias("table_name"), "n_rows", "content"))
    return reduce(DataFrame.unionByName, parts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count/qty metric computed while the write runs (no second scan)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "qty" in df.columns:
        metrics.append(F.sum("qty").alias("qty"))
    return df.observe(obs, *metrics), obs
