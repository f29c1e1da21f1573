"""Data-quality checks, the dead-letter table, reconciliation and sampled audits.

Checks return *violations* as rows (never drop them silently). Each check is
one pass over its input: null counts are a single aggregate with one
``count_if`` per column, key checks are anti-joins against size-checked
key sets, uniqueness is a partial-aggregating ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .aggregates import observed
from .keys import bounded_broadcast, key_set, known_rows


def dq_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, n_null) for each declared NOT NULL column, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "n_null")
    return long.select(F.lit(table).alias("table_name"), "column_name", F.col("n_null").cast("bigint"))


def dq_in_set(df: DataFrame, key: str, column: str, allowed: Sequence) -> DataFrame:
    """Rows whose ``column`` is outside ``allowed`` (NULL passes, as a CHECK does)."""
    bad = df.where(~F.col(column).isin(list(allowed)))
    return bad.select(key, F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"))


def dq_compare(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Rows violating ``a <= b`` (NULL passes)."""
    bad = df.where(~(F.col(a) <= F.col(b)))
    return bad.select(key, F.col(a).alias(a), F.col(b).alias(b))


def dq_foreign_key(df: DataFrame, checks: Mapping[str, DataFrame], id_col: str = "id") -> DataFrame:
    """(fk_column, key_value, n_rows) for non-NULL keys missing from their parent.

    One scan: every key is probed against its size-checked key set in the same
    pass, failed references are exploded and counted (partial aggregate).
    """
    probed = df.select(*checks.keys())
    misses = []
    for i, (fk, parent) in enumerate(checks.items()):
        ks = key_set(parent, id_col, f"_k{i}").withColumn(f"_hit{i}", F.lit(True))
        ks = bounded_broadcast(ks, upper_bound=known_rows(parent))
        probed = probed.join(ks, F.col(fk) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        misses.append(F.when(F.col(fk).isNotNull() & F.col(f"_hit{i}").isNull(),
                             F.struct(F.lit(fk).alias("fk_column"), F.col(fk).cast("bigint").alias("key_value"))))
    bad = probed.select(F.explode(F.array(*misses)).alias("m")).where(F.col("m").isNotNull())
    return bad.groupBy("m.fk_column", "m.key_value").agg(F.count(F.lit(1)).alias("n_rows"))


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def dq_length(df: DataFrame, key: str, bounds: Mapping[str, int]) -> DataFrame:
    """Rows whose text exceeds a declared VARCHAR(n) bound: key, column, length, bound (one scan)."""
    checks = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.length(c).alias("length"), F.lit(n).alias("bound"))
        for c, n in bounds.items()
    ])
    long = df.select(key, F.explode(checks).alias("_c")).select(key, "_c.column_name", "_c.length", "_c.bound")
    return long.where(F.col("length") > F.col("bound"))


def dq_row_rejects(
    df: DataFrame,
    in_set: Mapping[str, Sequence] | None = None,
    compare: Sequence[tuple[str, str]] | None = None,
    lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows failing any row-level rule (DQ2 in-set, DQ3 a <= b, DQ6 length), one pass.

    Returns the failing rows with ``fk_reason`` naming every failed rule, the
    shape ``dlq`` takes (NULL values pass, as a CHECK constraint does).
    """
    reasons = []
    for c, allowed in (in_set or {}).items():
        reasons.append(F.when(~F.col(c).isin(list(allowed)), F.lit(f"not_in_set_{c}")))
    for a, b in compare or []:
        reasons.append(F.when(~(F.col(a) <= F.col(b)), F.lit(f"{a}_gt_{b}")))
    for c, n in (lengths or {}).items():
        reasons.append(F.when(F.length(c) > n, F.lit(f"too_long_{c}")))
    flagged = df.withColumn("fk_reason", F.nullif(F.concat_ws(",", *reasons), F.lit("")))
    return flagged.where(F.col("fk_reason").isNotNull())


def dlq(rejects: DataFrame, source: str, key_cols: Sequence[str], reason_col: str = "fk_reason") -> DataFrame:
    """Dead-letter rows: source table, key text, reason, and the whole row as JSON."""
    payload = [c for c in rejects.columns if c != reason_col]
    return rejects.select(
        F.lit(source).alias("source_table"),
        F.concat_ws(":", *[F.col(k).cast("string") for k in key_cols]).alias("row_key"),
        F.col(reason_col).alias("reason"),
        F.to_json(F.struct(*payload)).alias("payload"),
    )


def _daily(df: DataFrame, date_col: str, measure: str | None) -> DataFrame:
    day = F.to_date(F.col(date_col)).cast("timestamp_ntz").alias("day")
    agg = F.count(F.lit(1)) if measure is None else F.sum(measure)
    return df.groupBy(day).agg(agg.cast("bigint").alias("v"))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    table: str,
    date_col: str = "sell_date",
    measure: str | None = None,
) -> DataFrame:
    """Per-day source vs target totals (row counts, or ``sum(measure)``), full outer join, diff."""
    s = _daily(source, date_col, measure).withColumnRenamed("v", "source_value")
    t = _daily(target, date_col, measure).withColumnRenamed("v", "target_value")
    j = s.join(t, "day", "full")
    j = j.select(
        F.lit(table).alias("table_name"),
        "day",
        F.coalesce("source_value", F.lit(0)).cast("bigint").alias("source_value"),
        F.coalesce("target_value", F.lit(0)).cast("bigint").alias("target_value"),
    )
    return j.withColumn("diff", F.col("source_value") - F.col("target_value"))


def written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` read back from a fresh folder under ``spark.checkpoint.dir``, and its rows, counted as they were written."""
    path = scratch_path(df.sparkSession, name)
    rows, obs = observed(df, name)
    rows.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), obs.get["rows"]


def audit_strata(source: DataFrame, target: DataFrame, table: str, key: Sequence[str], strata: Sequence[str], compare: Sequence[str], k: int,
                 seed: str = "audit") -> DataFrame:
    """table_name, row_key, the strata, same, found: the ``k`` source rows of least hash in every stratum against the target.

    The least hashes of a stratum are those of its parts merged, so each task keeps
    ``k`` rows a stratum before the shuffle (group limit), and the sample is the same for any partitioning.
    The sample is written once under ``spark.checkpoint.dir``, with its rows counted. If these are few it is the
    side that is broadcast, and never the target, whose files may be small beside its rows in memory.
    """
    name = F.concat_ws(":", *[F.col(c).cast("string") for c in key])
    h = F.md5(F.concat(F.col("row_key"), F.lit("|" + seed)))
    order = Window.partitionBy(*strata).orderBy("_h", "row_key")
    columns = list(dict.fromkeys([*strata, *compare]))
    sample = source.select(name.alias("row_key"), *key, *[c for c in columns if c not in key]).withColumn("_h", h)
    sample = sample.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_h", "_rank")
    sample, n = written(sample, "audit")
    there = target.select(*[F.col(c).alias(f"t_{c}") for c in dict.fromkeys([*key, *compare])], F.lit(True).alias("_found"))
    keys = bounded_broadcast(sample.select(*[F.col(c).alias(f"s_{c}") for c in key]).distinct(), upper_bound=n)
    there = there.join(keys, [F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}")) for c in key], "left_semi")
    j = sample.join(there.hint("merge"), [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in key], "left")
    found = F.coalesce("_found", F.lit(False))
    same = found
    for c in compare:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    return j.select(F.lit(table).alias("table_name"), "row_key", *strata, same.alias("same"), found.alias("found"))


def audit_sample(
    source: DataFrame,
    target: DataFrame,
    key: str,
    compare: Sequence[str],
    n: int = 100,
    seed: str = "audit",
) -> DataFrame:
    """Deterministic sample of ``n`` source keys (smallest md5 of key|seed), compared null-safely.

    ``orderBy(...).limit(n)`` runs as a per-task top-n and a small merge;
    the target side is read only for the sampled keys (semi-join first).
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("|" + seed)))
    sample = source.select(key, *compare).withColumn("_h", h).orderBy("_h").limit(n)
    keys = sample.select(key)
    t = target.join(bounded_broadcast(keys, n, upper_bound=n), key, "left_semi").select(
        key, *[F.col(c).alias(f"t_{c}") for c in compare], F.lit(True).alias("_found")
    )
    j = sample.join(t, key, "left")
    found = F.coalesce("_found", F.lit(False))
    checks = [(found & F.col(c).eqNullSafe(F.col(f"t_{c}"))).alias(f"{c}_match") for c in compare]
    return j.select(key, *checks, found.alias("found"))
