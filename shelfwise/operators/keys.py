"""Foreign-key membership operators: nullify, semi-filter, reject, lookup.

Key sets are one-column projections of (already loaded) dimension targets.
They are broadcast only behind a row-count check (``bounded_broadcast``);
above the bound the join stays a shuffle join, and AQE may still turn it
into a broadcast at runtime from the measured size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import positive

# A key set of 20M ints is ~160 MB uncompressed in a hashed relation; stay well below.
MAX_BROADCAST_ROWS = 2_000_000


_CHECKED: dict[tuple, bool] = {}
_KNOWN_ROWS: dict[tuple, int] = {}


def _plan_key(df: DataFrame) -> tuple:
    from ..session import session_key

    return (session_key(df.sparkSession), df.semanticHash())


def remember_rows(df: DataFrame, n: int) -> DataFrame:
    """Record a measured row count of ``df`` (e.g. observed while it was written)."""
    _KNOWN_ROWS[_plan_key(df)] = int(n)
    return df


def known_rows(df: DataFrame) -> int | None:
    return _KNOWN_ROWS.get(_plan_key(df))


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, upper_bound: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged.

    ``upper_bound`` is a row count already measured for the input ``df`` derives
    from (a key set has at most as many rows as its table). Without one, the
    check is a count (partial sums, no rows move) over the (small,
    column-pruned) side only; its verdict is remembered per analysed plan for
    the session, so a key set used by several joins is counted once.
    """
    if upper_bound is not None and upper_bound <= max_rows:
        return F.broadcast(df)
    key = (*_plan_key(df), max_rows)
    if key not in _CHECKED:
        _CHECKED[key] = df.count() <= max_rows
    return F.broadcast(df) if _CHECKED[key] else df


def key_set(target: DataFrame, id_col: str = "id", out: str = "_k") -> DataFrame:
    """Distinct non-null ids of a target (the membership set)."""
    return target.select(F.col(id_col).alias(out)).where(F.col(out).isNotNull()).distinct()


def _probe(df: DataFrame, fk: str, valid: DataFrame, id_col: str, tag: str, max_rows: int):
    ks = key_set(valid, id_col, f"_k_{tag}").withColumn(f"_hit_{tag}", F.lit(True))
    ks = bounded_broadcast(ks, max_rows, known_rows(valid))
    return df.join(ks, df[fk] == ks[f"_k_{tag}"], "left").drop(f"_k_{tag}")


def fk_nullify(
    df: DataFrame,
    checks: Mapping[str, DataFrame],
    id_col: str = "id",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Keep every row; set each foreign key not found in its valid set to NULL.

    ``checks`` maps fk column -> DataFrame holding the valid ``id_col``.
    """
    out = df
    for i, (fk, valid) in enumerate(checks.items()):
        tag = f"n{i}"
        out = _probe(out, fk, valid, id_col, tag, max_rows)
        out = out.withColumn(fk, F.when(F.col(f"_hit_{tag}"), F.col(fk))).drop(f"_hit_{tag}")
    return out.select(*df.columns)


def fk_semi_filter(
    df: DataFrame,
    checks: Mapping[str, DataFrame],
    id_col: str = "id",
    require_positive: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Drop rows whose key is non-positive or unknown (hash semi-joins)."""
    out = df.where(positive(*checks.keys())) if require_positive else df
    for fk, valid in checks.items():
        ks = bounded_broadcast(key_set(valid, id_col, "_k"), max_rows, known_rows(valid))
        out = out.join(ks, out[fk] == ks["_k"], "left_semi")
    return out


def fk_flags(
    df: DataFrame,
    checks: Mapping[str, DataFrame],
    id_col: str = "id",
    require_positive: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
    nullable: bool = False,
) -> DataFrame:
    """Append ``fk_reason`` (NULL when all keys pass), one left probe per key.

    With ``nullable`` a NULL key passes (an optional reference); only a
    non-NULL id missing from its parent fails.
    """
    out = df
    reasons: list[Column] = []
    for i, (fk, valid) in enumerate(checks.items()):
        tag = f"r{i}"
        out = _probe(out, fk, valid, id_col, tag, max_rows)
        ok = F.col(f"_hit_{tag}").isNotNull()
        if require_positive:
            ok = ok & positive(fk)
        if nullable:
            ok = ok | F.col(fk).isNull()
        reasons.append(F.when(~ok, F.lit(f"unknown_{fk}")))
    flagged = out.withColumn("fk_reason", F.concat_ws(",", *reasons))
    flagged = flagged.withColumn("fk_reason", F.nullif(F.col("fk_reason"), F.lit("")))
    return flagged.select(*df.columns, "fk_reason")


def fk_reject(
    df: DataFrame,
    checks: Mapping[str, DataFrame],
    id_col: str = "id",
    require_positive: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The complement of ``fk_semi_filter``: dropped rows with the failed keys named."""
    return fk_flags(df, checks, id_col, require_positive, max_rows).where(F.col("fk_reason").isNotNull())


def key_lookup(keys: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Batch form of get-by-id: every requested key, its row, and ``found``."""
    t = table.withColumn("_found", F.lit(True))
    out = keys.select(key).join(t, key, "left")
    return out.withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found")
