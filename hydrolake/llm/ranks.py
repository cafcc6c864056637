"""Dense positions of rows in a total order, for any number of rows and any hot group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Bits that ``monotonically_increasing_id`` leaves for the row within a partition.
_ROW_BITS = 33


def partitions(df: DataFrame) -> int:
    """How many tasks ``df`` is worth: its own partitions, and no fewer than a shuffle has."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def positions(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``_pos``, their place from 0 within the group by ``order``, and ``_n``, the group's rows.

    The rows are range-partitioned by (group, order), so a hot group is spread over many tasks; what
    each task holds of a group is summed up over the tasks.  ``order`` should end in a column that
    tells rows apart, or rows equal in all of them stay in one task.  Group columns are never null.
    Give rows that are cheap to read twice: finding the ranges reads them once more.
    """
    dealt = rows.repartitionByRange(partitions(rows), *group, *order).sortWithinPartitions(*group, *order)
    dealt = cut(dealt.withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_task", F.shiftright("_at", _ROW_BITS))
    held = dealt.groupBy("_task", *group).agg(F.min("_at").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    of = Window.partitionBy(*group)         # as many rows as tasks hold the group
    earlier = F.sum("_rows").over(of.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("_task", *group, (F.coalesce(earlier, F.lit(0)) - F.col("_least")).alias("_shift"), F.sum("_rows").over(of).alias("_n"))
    return dealt.join(held, ["_task", *group]).withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_task", "_at", "_shift")
