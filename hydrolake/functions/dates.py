"""Date keys, date parts and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import BUDDHIST_ERA_OFFSET, THAI_MONTHS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyyMMdd as INT, by arithmetic: formatting a date costs several times as much."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_date_lenient(c, fallback=None) -> Column:
    """Parse a date string; unparsable -> ``fallback`` (a Column) or NULL."""
    parsed = _c(c).cast("string").try_cast("date")
    return parsed if fallback is None else F.coalesce(parsed, _c(fallback))


def month_start_key(year, month) -> Column:
    """Date key of ``year-month-01``; NULL for invalid months (e.g. 0)."""
    s = F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"), F.lit("-01"))
    return date_key(F.try_to_date(s, "yyyy-MM-dd"))


def thai_month_name(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in THAI_MONTHS]), _c(month).cast("int"))


def date_parts(d) -> dict[str, Column]:
    """All Dim_Date attributes of a date column (1 = Sunday for day_of_week)."""
    d = _c(d)
    dow = F.dayofweek(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "month": F.month(d),
        "month_name_th": thai_month_name(F.month(d)),
        "day": F.dayofmonth(d),
        "quarter": F.quarter(d),
        "day_of_week": dow,
        "day_name_en": F.date_format(d, "EEEE"),
        "is_weekend": dow.isin(1, 7),
        "thai_year": F.year(d) + BUDDHIST_ERA_OFFSET,
    }


def iso_ts_string(ts) -> Column:
    """Timestamp -> ISO-8601 string with microseconds (lexicographically ordered)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
