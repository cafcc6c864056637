"""Deterministic de-duplication operators.

All of them shuffle once on the key and keep one row per key with a *total*
order (explicit tie-breakers), so the result never depends on input order.
Spark turns ``row_number() == 1`` into a per-partition sort with a
WindowGroupLimit, so hot keys are bounded by the sort's spill, not memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def keep_first(df: DataFrame, keys: list[str], order: list, rank_col: str = "_rn") -> DataFrame:
    """Keep the first row of every key group under ``order`` (a total order)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def dedup_latest(df: DataFrame, keys: list[str], latest_col: str, tie_breakers: list | None = None) -> DataFrame:
    """Keep the latest row per key by ``latest_col`` descending, NULLs last."""
    order = [F.col(latest_col).desc_nulls_last()] + list(tie_breakers or [])
    return keep_first(df, keys, order)


def dedup_first(df: DataFrame, keys: list[str], sort_cols: list, tie_breakers: list | None = None) -> DataFrame:
    """Sort by ``sort_cols`` ascending and keep the first row per key."""
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in sort_cols] + list(tie_breakers or [])
    return keep_first(df, keys, order)


def flag_duplicates(df: DataFrame, keys: list[str], flag_col: str = "is_duplicate") -> DataFrame:
    """Mark every member of a duplicate group (``keep=False`` semantics)."""
    w = Window.partitionBy(*keys)
    return df.withColumn(flag_col, F.count(F.lit(1)).over(w) > 1)


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).dropDuplicates(cols)
