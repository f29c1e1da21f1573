"""Connected components of links, by alternating large and small stars.

Every step is a partial aggregate and a join on Spark, written to the shared
folder before the next; links and labels never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut


#: Links up to this many are worked on in one partition, where no step needs a shuffle; more in hash partitions.
ONE_PARTITION = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the larger (or no larger) neighbours of every node on its least neighbour."""
    if large:
        both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")
        both = edges.select(both).select("e.a", "e.b")
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node with a link; ``root`` is the least node of its component. ``edges``: a, b."""
    now = cut(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    mark = None
    while True:
        n = now.count()
        seen = (n, now.agg(F.sum(F.xxhash64("a", "b") % (1 << 40))).first()[0])
        if mark == seen or not n:
            pair = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), F.struct(F.col("b").alias("node"), F.col("b").alias("root")))
            return now.select(F.explode(pair).alias("e")).select("e.node", "e.root").distinct()
        mark = seen
        dealt = now.coalesce(1) if n <= ONE_PARTITION else now
        now = cut(_star(_star(dealt, True), False), "edges")
