"""Column expressions for the cleansing rules (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import ACTIVE_FLAG, PARTITION_SUFFIX_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_if_empty(c, value) -> Column:
    """'' or NULL -> ``value`` (a NULL scans to '' in the source DTOs)."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(value))


def empty_if_null(c) -> Column:
    """NULL string -> '' (non-pointer DTO fields)."""
    return F.coalesce(_c(c), F.lit(""))


def zero_if_null(c) -> Column:
    """NULL number -> 0 (``NVL(c, 0)``)."""
    return F.coalesce(_c(c), F.lit(0))


def flag_to_bool(c, yes: str = ACTIVE_FLAG) -> Column:
    """``flag == 'Y'``; NULL is false, never NULL."""
    return _c(c).eqNullSafe(F.lit(yes))


def positive(*cols) -> Column:
    """``c1 > 0 AND c2 > 0 ...``; NULL keys fail the guard."""
    out = None
    for c in cols:
        p = F.coalesce(_c(c) > 0, F.lit(False))
        out = p if out is None else out & p
    return out


def day_trunc(c) -> Column:
    """Day of a timestamp, kept as ``timestamp_ntz`` (midnight)."""
    return F.to_date(_c(c)).cast("timestamp_ntz")


def month_trunc(c) -> Column:
    """First instant of the month, as ``timestamp_ntz``."""
    return F.trunc(_c(c), "MM").cast("timestamp_ntz")


def year_trunc(c) -> Column:
    return F.trunc(_c(c), "YEAR").cast("timestamp_ntz")


def date_text_key(c, fmt: str = "yyyyMMdd") -> Column:
    """Text keys such as ``yyyyMMdd`` or ``MMyyyy``."""
    return F.date_format(_c(c), fmt)


def partition_suffix(c) -> Column:
    """Monthly partition suffix ``y2026m08`` (fixed format of the store)."""
    return F.date_format(_c(c), PARTITION_SUFFIX_PATTERN)


def suffix_match(c, suffix: str) -> Column:
    """Case-insensitive suffix match, the query a ``reverse(lower(name))`` index serves."""
    return F.lower(_c(c)).endswith(suffix.lower())


def hash_long(c) -> Column:
    """Stable 60-bit BIGINT id from text (md5 prefix)."""
    return F.conv(F.substring(F.md5(_c(c)), 1, 15), 16, 10).cast("bigint")


def round6(c) -> Column:
    return F.round(_c(c).cast("double"), 6)
