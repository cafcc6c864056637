"""Window operators: calendar-day deltas and means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F




def calendar_delta(df: DataFrame, part: list[str], date_col: str, value: str, out: str,
                   days: int = 1, missing=0.0) -> DataFrame:
    """``value - value at exactly date - days`` (calendar based, not row based).

    One window pass: the previous row counts only if its date is exactly
    ``days`` earlier; otherwise ``missing``.  Assumes one row per (part, date).
    """
    w = Window.partitionBy(*part).orderBy(date_col)
    prev_v = F.lag(value, 1).over(w)
    prev_d = F.lag(date_col, 1).over(w)
    d = F.when(prev_d == F.date_sub(F.col(date_col), days), F.col(value) - prev_v)
    return df.withColumn(out, F.coalesce(d, F.lit(missing)) if missing is not None else d)


def range_mean(df: DataFrame, part: list[str], date_col: str, value: str, days: int, out: str) -> DataFrame:
    """Mean over the calendar range [date - (days-1), date] per partition key."""
    w = (Window.partitionBy(*part).orderBy(F.unix_date(F.col(date_col)))
         .rangeBetween(-(days - 1), 0))
    return df.withColumn(out, F.avg(value).over(w))
