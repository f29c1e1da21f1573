"""Persistent surrogate keys: one integer id for each distinct natural key, kept across runs.

A dictionary is a snapshot table (key, id). Keys not yet in it get the next
ids, in the order of the keys: the unseen keys are range-partitioned and
sorted, and a partition's ids begin after the rows of the partitions before
it. So ids are dense, never collide, and do not depend on the partitioning.
Only one count a partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec
from ..session import scratch_path
from .upsert import publish_snapshot, read_snapshot

KEYS = TableSpec(
    "keys",
    T.StructType([T.StructField("key", T.StringType()), T.StructField("id", T.LongType())]),
    ("key",),
    (),
)
#: monotonically_increasing_id keeps the row's place in its partition in the lower bits.
_PLACE_BITS = 33


def numbered(keys: DataFrame, after: int, partitions: int) -> DataFrame:
    """key, id: the distinct keys in order, numbered from ``after`` + 1."""
    spark = keys.sparkSession
    place = F.monotonically_increasing_id()
    placed = keys.repartitionByRange(partitions, "key").sortWithinPartitions("key").select("key", place.alias("place"))
    path = scratch_path(spark, "keys", "unseen")
    placed.write.parquet(path)  # places stay what they are when a task is run again
    placed = spark.read.schema(placed.schema).parquet(path).select("key", F.shiftright("place", _PLACE_BITS).alias("part"), F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1).alias("at"))
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, after
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    start = spark.createDataFrame(list(before.items()) or [], "part long, start long")
    return placed.join(F.broadcast(start), "part").select("key", (F.col("start") + F.col("at") + 1).alias("id"))


def extend(spark: SparkSession, root: str, natural: DataFrame) -> DataFrame:
    """The dictionary at ``root`` with every non-NULL value of the one column of ``natural``; publishes it if it grew."""
    natural = natural.toDF("key").where("key is not null").distinct()
    known = read_snapshot(spark, root, KEYS)
    unseen = natural.join(known, "key", "left_anti")
    if unseen.isEmpty():
        return known
    last = known.agg(F.max("id")).first()[0] or 0
    new = numbered(unseen, last, int(spark.conf.get("spark.sql.shuffle.partitions")))
    publish_snapshot(spark, root, known.unionByName(new), sort_by=["key"])
    whole = read_snapshot(spark, root, KEYS)
    check(whole, "key", "id")
    return whole


def check(df: DataFrame, key: Column | str, id_col: str) -> None:
    """Raises unless keys and ids meet one to one; a load with fewer ids than keys must not go on."""
    pairs = df.select(F.col(key) if isinstance(key, str) else key, id_col).distinct().toDF("key", "id")
    n, keys, ids = pairs.agg(F.count(F.lit(1)), F.count_distinct("key"), F.count_distinct("id")).first()
    if not n == keys == ids:
        raise ValueError(f"{n} pairs, {keys} keys and {ids} ids: keys and ids are not one to one")
