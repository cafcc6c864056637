"""Aggregation operators: top-k concatenation, pivot counts, profiles, value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk_concat(df: DataFrame, keys: list[str], order: list, k: int, concat_cols: dict[str, str],
                sep: str = ",") -> DataFrame:
    """Per group: the first ``k`` rows under ``order`` concatenated in that order.

    ``concat_cols`` maps output name -> source column.  The window keeps at most
    k rows per group (WindowGroupLimit), so the collected arrays are bounded.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    aggs = []
    for out, src in concat_cols.items():
        arr = F.array_sort(F.collect_list(F.struct(F.col("_rk"), F.col(src).cast("string").alias("v"))))
        aggs.append(F.array_join(F.transform(arr, lambda x: x["v"]), sep).alias(out))
    return top.groupBy(*keys).agg(*aggs)


def topk_concat_and_max(df: DataFrame, keys: list[str], order: list, k: int, concat_cols: dict[str, str], max_cols: dict[str, str],
                        unique: list[str], cells: int = 16, sep: str = ",", each: tuple[str, str] | None = None) -> DataFrame:
    """``topk_concat`` and the maxima of ``max_cols`` (output name -> column) in one pass, no join of two aggregates.

    Rows are told apart by ``unique`` (within a group one row each; of equal ones any stays).  Each group is first spread over ``cells`` by
    a hash of those columns: one shuffle serves the deduplication and the best rows of each cell, so a hot group has ``cells`` tasks.  At most
    ``k`` rows a cell go on, with the cell's maxima.

    ``each`` = (key, array column): a row counts for every value that its array lists for that key.  Rows with equal arrays share their
    cells, and only the best of a cell are repeated per value.
    """
    def best(rows: DataFrame, part: list[str], maxima: dict[str, str]) -> DataFrame:
        w = Window.partitionBy(*part)
        return (rows.select(*[c for c in rows.columns if c not in maxima and c != "_rk"], F.row_number().over(w.orderBy(*order)).alias("_rk"),
                            *[F.max(src).over(w).alias(out) for out, src in maxima.items()]).where(F.col("_rk") <= k))

    own = [f"_max_{out}" for out in max_cols]
    cell = F.pmod(F.xxhash64(*unique), F.lit(cells))
    near = [each[1] if each and c == each[0] else c for c in keys]
    spread = df.withColumn("_cell", cell).repartition(*near, "_cell").dropDuplicates([*near, "_cell", *unique])
    first = best(spread, [*near, "_cell"], {o: src for o, src in zip(own, max_cols.values())})
    if each:    # arrays that share a value may share a row, whose maxima are those of several cells
        spread = first.withColumn(each[0], F.explode(each[1])).repartition(*keys)
        same = Window.partitionBy(*keys, *unique)
        first = spread.select(*[c for c in spread.columns if c not in own], *[F.max(c).over(same).alias(c) for c in own]).dropDuplicates([*keys, *unique])
    top = best(first, keys, {o: o for o in own})
    parts = [F.array_sort(F.collect_list(F.struct("_rk", F.col(src).cast("string").alias("v")))) for src in concat_cols.values()]
    return top.groupBy(*keys).agg(*[F.array_join(F.transform(a, lambda x: x["v"]), sep).alias(o) for o, a in zip(concat_cols, parts)],
                                  *[F.max(c).alias(o) for o, c in zip(max_cols, own)])


def pivot_counts(df: DataFrame, keys: list[str], col: str, values: dict[str, str]) -> DataFrame:
    """Counts of each listed category flattened into columns (absent -> 0).

    ``values`` maps category value -> output column.  ``count_if`` keeps it one
    partial+final hash aggregate with a fixed output schema (no pivot discovery).
    """
    aggs = [F.count_if(F.col(col) == v).alias(out) for v, out in values.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def profile(df: DataFrame, key_cols: list[str], numeric_col: str | None = None,
            zero_col: str | None = None, true_col: str | None = None) -> DataFrame:
    """One-row profile: rows, nulls per key column, min/max/mean, zero and true counts."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in key_cols]
    if numeric_col:
        aggs += [F.min(numeric_col).alias(f"min_{numeric_col}"), F.max(numeric_col).alias(f"max_{numeric_col}"),
                 F.avg(numeric_col).alias(f"mean_{numeric_col}")]
    if zero_col:
        aggs.append(F.count_if(F.col(zero_col) == 0).alias(f"zeros_{zero_col}"))
    if true_col:
        aggs.append(F.count_if(F.col(true_col)).alias(f"true_{true_col}"))
    return df.agg(*aggs)


def mode_of(col: str) -> Column:
    """Most frequent value; ties -> smallest (deterministic)."""
    return F.mode(F.col(col), deterministic=True)


def count_by_partition(df: DataFrame, part_col: str = "dt", out: str = "row_count") -> DataFrame:
    return df.groupBy(part_col).agg(F.count(F.lit(1)).alias(out))
