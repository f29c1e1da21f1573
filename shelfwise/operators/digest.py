"""Additive multiset digests of tables, and a descent to the rows that differ.

A row's digest is two 64-bit hashes over its columns and which of them are
NULL; a range's digest is its row count and the sums of both. Sums add, so a
digest needs one partial aggregate, two tables compare whatever their order or
partitioning, and a row that is doubled shows as well as one that is lost.

``descend`` compares two tables level by level (month, then day; or hash
ranges): only ranges that differ are read at the next level, and only rows of
the last differing ranges are joined. The level values that reach the driver
are bounded by the calendar or by the number of hash ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_VALUE = "-"


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """A hash of a row's values that tells NULL in one column from NULL in another."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *[F.isnull(c) for c in columns])


def digests(df: DataFrame, by: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """``by`` columns -> n, h1, h2: the multiset digest of each range."""
    sums = [F.sum(row_hash(columns, seed).cast("decimal(20,0)")).cast("string").alias(f"h{seed}") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)


def differing(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges whose digests differ, with the row counts of both sides."""
    left = a.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("n").alias("n_a"), F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    right = b.select(*by, F.col("n").alias("n_b"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    on = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in by]
    j = left.join(right, on, "full")
    same = F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("a1").eqNullSafe(F.col("b1")) & F.col("a2").eqNullSafe(F.col("b2"))
    zero = F.lit(0).cast("long")
    return j.where(~same).select(*[F.coalesce(f"_{c}", c).alias(c) for c in by], F.coalesce("n_a", zero).alias("n_a"), F.coalesce("n_b", zero).alias("n_b"))


@dataclass(frozen=True)
class Level:
    """A way to cut both tables into ranges: the same text from a row of either side.

    On a partitioned target ``target`` names the partition column, so that ranges that agree are not read again.
    """

    name: str
    source: Column
    target: Column


def month_levels(date_col: str, month_col: str | None = "sell_month") -> list[Level]:
    """Month, then day, of ``date_col``; the target's months are its partitions."""
    month = F.coalesce(F.date_format(F.trunc(F.col(date_col), "MM"), "yyyy-MM-dd"), F.lit(NO_VALUE))
    day = F.coalesce(F.date_format(F.col(date_col), "yyyy-MM-dd"), F.lit(NO_VALUE))
    part = F.coalesce(F.col(month_col).cast("string"), F.lit(NO_VALUE)) if month_col else month
    return [Level("month", month, part), Level("day", day, day)]


def hash_levels(keys: Sequence[str], ranges: Sequence[int] = (64, 4096)) -> list[Level]:
    """Hash ranges of the key for tables without a date; each level splits the one before."""
    h = F.pmod(row_hash(keys, 7), F.lit(ranges[-1]))
    return [Level(f"range_{n}", c, c) for n in ranges for c in [F.pmod(h, F.lit(n)).cast("string")]]


def descend(source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], levels: Sequence[Level]) -> DataFrame:
    """key, state, n_source, n_target of the keys whose rows differ.

    ``state`` is ``lost`` (no target row), ``added`` (no source row), ``doubled``
    (the rows of the source, some more often) or ``changed``. NULL keys compare as values.
    """
    for level in levels:
        name = "_" + level.name
        ranges = differing(
            digests(source, [level.source.alias(name)], columns),
            digests(target, [level.target.alias(name)], columns),
            [name],
        )
        values = [r[0] for r in ranges.select(name).collect()]
        source, target = source.where(level.source.isin(values)), target.where(level.target.isin(values))
        if not values:
            break
    per = [F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(row_hash(columns, 1))).alias("rows")]

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy(*key).agg(*per)

    s, t = sums(source).alias("s"), sums(target).alias("t")
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]
    j = s.join(t, on, "full")
    same_rows = F.col("s.rows").eqNullSafe(F.col("t.rows"))
    state = (
        F.when(F.col("t.n").isNull(), "lost")
        .when(F.col("s.n").isNull(), "added")
        .when(same_rows & (F.col("s.n") != F.col("t.n")), "doubled")
        .when(~same_rows, "changed")
    )
    zero = F.lit(0).cast("long")
    out = j.select(
        *[F.when(F.col("s.n").isNotNull(), F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in key],
        state.alias("state"),
        F.coalesce("s.n", zero).alias("n_source"),
        F.coalesce("t.n", zero).alias("n_target"),
    )
    return out.where(F.col("state").isNotNull())
