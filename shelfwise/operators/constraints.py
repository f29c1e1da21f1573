"""Declared constraints of the target tables, checked in one scan a table.

NOT NULL, text bounds and foreign keys of a table become one flag a rule, all
in one pass: every foreign key is probed against its size-checked key set as
the rows stream by. The report is one aggregate of these flags; ``rejects``
returns the failing rows with all their reasons, as ``dlq`` takes them.
Uniqueness needs a second aggregate, which moves key columns only and combines
repeated keys before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CONSTRAINTS, TARGETS, Constraints
from .keys import bounded_broadcast, key_set, known_rows


def _rules(df: DataFrame, rules: Constraints, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, dict[tuple[str, str], Column]]:
    """The rows with their key probes, and (rule, column) -> whether a row fails it. NULL passes all but NOT NULL."""
    flags: dict[tuple[str, str], Column] = {("not_null", c): F.col(c).isNull() for c in rules.not_null}
    flags |= {("length", c): F.coalesce(F.length(c) > n, F.lit(False)) for c, n in rules.lengths.items()}
    for i, (c, parent) in enumerate(rules.references.items()):
        ks = key_set(parents[parent], "id", f"_k{i}").withColumn(f"_hit{i}", F.lit(True))
        df = df.join(bounded_broadcast(ks, upper_bound=known_rows(parents[parent])), F.col(c) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        flags["foreign_key", c] = F.col(c).isNotNull() & F.col(f"_hit{i}").isNull()
    return df, flags


def report(df: DataFrame, table: str, parents: Mapping[str, DataFrame], rules: Constraints | None = None) -> DataFrame:
    """table_name, rule, column_name, n_rows: rows that fail each declared rule, and for ``unique`` the keys held more than once."""
    rules = rules or CONSTRAINTS[table]
    keys = rules.unique or TARGETS[table].keys
    flagged, flags = _rules(df, rules, parents)
    parts = []
    if flags:
        one = flagged.agg(*[F.count_if(c).alias(f"{rule}:{col}") for (rule, col), c in flags.items()])
        long = one.unpivot([], one.columns, "name", "n_rows")
        parts.append(long.select(F.split("name", ":")[0].alias("rule"), F.split("name", ":")[1].alias("column_name"), "n_rows"))
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n_rows"))
    parts.append(twice.select(F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"), "n_rows"))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.select(F.lit(table).alias("table_name"), "rule", "column_name", F.col("n_rows").cast("bigint").alias("n_rows"))


def rejects(df: DataFrame, table: str, parents: Mapping[str, DataFrame], rules: Constraints | None = None) -> DataFrame:
    """Rows that fail a row rule, with ``fk_reason`` naming every failed one."""
    columns = df.columns
    flagged, flags = _rules(df, rules or CONSTRAINTS[table], parents)
    reasons = [F.when(c, F.lit(f"{rule}_{col}")) for (rule, col), c in flags.items()]
    reason = F.nullif(F.concat_ws(",", *reasons), F.lit(""))
    return flagged.select(*columns, reason.alias("fk_reason")).where(F.col("fk_reason").isNotNull())
