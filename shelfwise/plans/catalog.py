"""Registry of named queries: a Spark builder and (where SQL can say it) a DuckDB oracle.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables. Oracle SQL strings use the views of
``shelfwise.plans.oracle``; columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import with_views

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    """Decorator: add a query builder (and its oracle SQL) under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, with_views(sql, ctes) if sql else None)
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from . import q_load, q_quality, q_series, q_planning, q_misc, q_layout, q_stream  # noqa: F401


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1]}
