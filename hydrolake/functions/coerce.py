"""Null handling, numeric coercion and string conforming as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import TRUE_STRINGS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_numeric(c, default: float = 0.0) -> Column:
    """Parse to double; unparsable, null, NaN or infinite (however spelt) -> ``default``.

    ``try_cast`` keeps ANSI mode from raising; strings with a trailing type
    suffix (``'12d'``) are rejected as non-numeric.
    """
    col = _c(c)
    s = F.trim(col.cast("string"))
    parsed = F.when(~s.rlike("(?i)[dfl]$"), s.try_cast("double"))
    return F.coalesce(null_if_nan(parsed), F.lit(float(default)))


def coerce_int(c, default: int = 0) -> Column:
    """``coerce_numeric`` truncated towards zero to a 64-bit integer; beyond its range -> ``default``."""
    return F.coalesce(coerce_numeric(c, float(default)).try_cast("bigint"), F.lit(default).cast("bigint"))


def null_if_nan(c) -> Column:
    """NaN and +-Infinity become NULL (JSON/CSV exports must not carry them).

    A finite number is its own remainder by infinity and any other gives NaN, so ``c`` is evaluated once.
    """
    return F.nanvl(_c(c).cast("double") % F.lit(float("inf")), F.lit(None).cast("double"))


def first_truthy(*cols, numeric: bool = False) -> Column:
    """``a or b or c``: skips null, blank strings and (for numerics) zero."""
    if numeric:
        return F.coalesce(*[F.nullif(_c(c), F.lit(0)) for c in cols])
    return F.coalesce(*[F.nullif(F.trim(_c(c).cast("string")), F.lit("")) for c in cols])


def fill_default_string(c, default: str, blank_to_default: bool = False) -> Column:
    """null -> ``default``, trimmed; optionally blank -> ``default`` as well."""
    v = F.trim(F.coalesce(_c(c).cast("string"), F.lit(default)))
    if blank_to_default:
        v = F.coalesce(F.nullif(v, F.lit("")), F.lit(default))
    return v


def ensure_string(c) -> Column:
    """Absent/null -> '' and trimmed."""
    return F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))


def parse_bool(c) -> Column:
    """``lower(trim(str(x))) in {true,1,yes,t}``; null -> false."""
    s = F.lower(F.trim(_c(c).cast("string")))
    return F.coalesce(s.isin(TRUE_STRINGS), F.lit(False))


def clip(c, lo: float = 0.0, hi: float = 100.0) -> Column:
    """Clamp into [lo, hi]; NaN is treated as missing first (``least`` sorts NaN high)."""
    col = F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col))


def zero_pad(c, width: int = 6) -> Column:
    """Left-pad with zeros, never truncating longer input (``str.zfill``)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)



def parse_code_list(c) -> Column:
    """``"63, 62,x,,60"`` -> ``[63, 62, 60]``; null/blank -> ``[]``."""
    parts = F.transform(F.split(F.coalesce(_c(c).cast("string"), F.lit("")), ","), lambda x: F.trim(x))
    digits = F.filter(parts, lambda x: x.rlike("^[0-9]+$"))
    return F.transform(digits, lambda x: x.cast("int"))
