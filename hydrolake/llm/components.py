"""Connected components of a link table by alternating large-star and small-star steps.

Links and components stay in Spark.  Each round is a handful of aggregations over the
links and ends in the shared checkpoint folder; long chains of links shrink
geometrically, so rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One star step: each node's neighbours (larger ones, or the smaller and itself) go to its least neighbour."""
    if large:
        around = links.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            links.select(F.col("b").alias("n"), F.col("a").alias("m")))
    else:
        around = links.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("m"))
    # the least neighbour is found by an aggregate that combines before its shuffle, so a
    # node with very many neighbours is never gathered in one place
    least = around.groupBy("n").agg(F.min("m").alias("l")).select("n", F.least("n", "l").alias("l"))
    joined = around.join(least, "n")
    moved = joined.where(F.col("m") > F.col("n") if large else F.col("m") != F.col("l")).select(F.col("m").alias("a"), F.col("l").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("n").alias("a"), F.col("l").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node, component`` of every node that has a link; the component is its least node.

    Null ends, loops and repeated links are ignored; an empty table gives an empty result.
    """
    def low(x: str, y: str, f) -> Column:
        return f(F.col(x), F.col(y))

    now = cut(links.select(low(a, b, F.greatest).alias("a"), low(a, b, F.least).alias("b"))
              .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    mark = None
    for _ in range(max_rounds):
        now = cut(_stars(_stars(now, True), False))
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = found
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
