"""Stable, deterministic surrogate keys derived from natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(*parts, sep: str = "_") -> Column:
    """The full md5 of the parts, as 32 hex digits.

    Stable across runs, engines and clusters (unlike a row number).  All 128 bits are
    kept: a prefix or a modulus would give distinct rows the same key at scale, and
    joins on it would mix them.
    """
    return F.md5(F.concat_ws(sep, *[_c(p).cast("string") for p in parts]))


def reservoir_key(reservoir_id, source) -> Column:
    return md5_key(reservoir_id, source)


def fact_key(*parts) -> Column:
    return md5_key(*parts)


def natural_int_key(c) -> Column:
    """``CAST(geocode AS INT)`` that yields NULL instead of raising."""
    return _c(c).cast("string").try_cast("int")
