"""The stored monthly sales summary and its upkeep.

``root/sales`` holds (shop, product, month) totals, one partition a month;
``root/digests`` holds, for each month, the digest of the fact rows it was
summed from. ``refresh`` compares these with the fact's months and sums only
months that differ, so a late bill costs one month and a repeated load none.
Rows without a date belong to no month and are not summed.
The summary is overwritten before its digests are published: a run that dies
between finds the months dirty again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec
from ..session import path_exists
from .digest import differing, digests
from .series import monthly
from .upsert import publish_snapshot, read_snapshot

KEYS = ("shop_id", "product_id")
#: The fact's columns that the summary depends on.
COLUMNS = ("sell_id", "shop_id", "product_id", "qty", "sell_date")
DIGESTS = TableSpec(
    "digests",
    T.StructType([T.StructField("sell_month", T.DateType()), T.StructField("n", T.LongType()), T.StructField("h1", T.StringType()), T.StructField("h2", T.StringType())]),
    ("sell_month",),
    ("n", "h1", "h2"),
)
SALES = T.StructType(
    [
        T.StructField("shop_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("month", T.TimestampNTZType()),
        T.StructField("qty", T.LongType()),
        T.StructField("n_bills", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("sell_month", T.DateType()),
    ]
)


#: Lines that one task sums; their hash table takes some 300 bytes a line.
LINES_PER_TASK = 250_000
MAX_TASKS = 100_000


def _parts(lines: int) -> int:
    return max(1, min(MAX_TASKS, -(-lines // LINES_PER_TASK)))


def refresh(spark: SparkSession, fact_root: str, root: str, months: list | None = None) -> list:
    """Brings the summary of the month-partitioned fact up to date; the months that were summed anew.

    ``months`` limits the comparison to the months a load has touched (partition
    pruning); None compares all. A month without rows any more is emptied.
    """
    fact = spark.read.parquet(fact_root).where("sell_month is not null")
    stored = read_snapshot(spark, f"{root}/digests", DIGESTS)
    chosen = F.col("sell_month").isin(months) if months is not None else F.lit(True)
    now = digests(fact.where(chosen), [F.col("sell_month")], COLUMNS)
    found = now.collect()  # one row a month
    now = spark.createDataFrame(found, DIGESTS.schema)
    dirty = [r[0] for r in differing(stored.where(chosen), now, ["sell_month"]).select("sell_month").collect()]
    if not dirty:
        return []
    touched = set(dirty)
    parts = _parts(sum(r["n"] for r in found if r["sell_month"] in touched))
    sums = monthly(fact.where(F.col("sell_month").isin(dirty)), list(KEYS), partitions=parts).withColumn("sell_month", F.to_date("month"))
    (
        sums.hint("rebalance", "sell_month").sortWithinPartitions("sell_month", *KEYS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sell_month").parquet(f"{root}/sales")
    )
    kept = stored.where(~F.col("sell_month").isin(dirty))
    publish_snapshot(spark, f"{root}/digests", kept.unionByName(now.where(F.col("sell_month").isin(dirty))).coalesce(1))
    return sorted(dirty)


def read(spark: SparkSession, root: str) -> DataFrame:
    """shop_id, product_id, month, qty, n_bills, n_lines of every month that has rows."""
    if not path_exists(spark, f"{root}/sales"):
        return spark.createDataFrame([], SALES).drop("sell_month")
    # A month that has lost all its rows has no digest; its old partition is not read.
    live = [r[0] for r in read_snapshot(spark, f"{root}/digests", DIGESTS).select("sell_month").collect()]
    return spark.read.schema(SALES).parquet(f"{root}/sales").where(F.col("sell_month").isin(live)).drop("sell_month")


def first_month(spark: SparkSession, root: str) -> str | None:
    """The least month that has rows, for the start of dense calendars."""
    r = read_snapshot(spark, f"{root}/digests", DIGESTS).agg(F.min("sell_month")).first()
    return r[0].isoformat() if r[0] else None
