"""Join operators: substring joins, fallbacks, first row per key.

No join here depends on a size looked up while the plan is built, and none is a
nested loop: equi-joins are left to AQE, which picks broadcast or sort-merge from
runtime sizes and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F




# ---------------------------------------------------------------- substring join

def _grams(text: Column, size: Column) -> Column:
    """All distinct substrings of ``size`` code points of ``text``; none if it is shorter."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def _contained_pairs(texts: DataFrame, tid: str, pats: DataFrame, pid: str, k: int) -> DataFrame:
    """Pairs (tid, pid) with pats._s a substring of texts._s under the same _tag, via rare-gram blocking.

    Each pattern is keyed by its rarest gram (k-gram, or the whole pattern if
    shorter than k) among the text grams; candidates share that gram and are
    verified with ``contains``.  Work is proportional to the candidate pairs,
    never to |texts| x |patterns|.

    Texts have grams of the lengths that patterns are keyed by, mostly k alone.  A
    frame of grams is many times its names, which size estimates do not see, so the
    joins merge: no such frame is broadcast through the driver.
    """
    size = F.least(F.length("_s"), F.lit(k))
    sizes = pats.select("_tag", size.alias("_k")).distinct()    # k rows a tag at most
    tg = texts.join(F.broadcast(sizes), "_tag").select(tid, "_tag", F.col("_s").alias("_text"), F.explode(_grams(F.col("_s"), F.col("_k"))).alias("_g"))
    freq = tg.groupBy("_tag", "_g").agg(F.count(F.lit(1)).alias("_df"))
    pg = pats.select(pid, "_tag", "_s", F.explode(_grams(F.col("_s"), size)).alias("_g"))
    # a gram absent from every text means the pattern cannot match: inner join drops it
    rare = (pg.hint("merge").join(freq, ["_tag", "_g"]).groupBy(pid, "_tag", "_s")
            .agg(F.min_by("_g", F.struct(F.col("_df"), F.col("_g"))).alias("_g")))
    return rare.join(tg.hint("merge"), ["_tag", "_g"]).where(F.col("_text").contains(F.col("_s"))).select(tid, pid)


def substring_match_pairs(texts: DataFrame, tid: str, pats: DataFrame, pid: str,
                          columns: list[tuple[str, str, bool]], k: int = 3) -> DataFrame:
    """Distinct (tid, pid) where, for any of ``columns``, the trimmed pattern and text contain one another.

    ``columns`` lists (text column, pattern column, case-insensitive); all of them
    are matched in one n-gram join each way, told apart by a tag.  Empty and NULL
    strings on either side never match.
    """
    def tagged(df: DataFrame, key: str, at: int) -> DataFrame:
        norm = [F.struct(F.lit(i).alias("_tag"), (F.lower(F.trim(c[at])) if c[2] else F.trim(c[at])).alias("_s"))
                for i, c in enumerate(columns)]
        return df.select(F.col(key), F.inline(F.array(*norm))).where(F.length("_s") > 0)

    t, p = tagged(texts, tid, 0), tagged(pats, pid, 1)
    return _contained_pairs(t, tid, p, pid, k).unionByName(_contained_pairs(p, pid, t, tid, k)).distinct()


# ---------------------------------------------------------------- fallbacks

def fallback_per_key(primary: DataFrame, secondary: DataFrame, keys: list[str], value_cols: list[str],
                     primary_label: str, secondary_label: str, source_col: str = "data_source") -> DataFrame:
    """Per key take the primary row if one exists, else the secondary row; record provenance."""
    p = primary.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in value_cols], F.lit(True).alias("_has_p"))
    s = secondary.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in value_cols])
    j = s.join(p, keys, "full")
    has_p = F.coalesce(F.col("_has_p"), F.lit(False))
    cols = [F.when(has_p, F.col(f"_p_{c}")).otherwise(F.col(f"_s_{c}")).alias(c) for c in value_cols]
    src = F.when(has_p, F.lit(primary_label)).otherwise(F.lit(secondary_label)).alias(source_col)
    return j.select(*keys, *cols, src)


def fallback_whole(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """All primary rows if there are any, else all secondary rows.

    Stays lazy: the emptiness test is an uncorrelated EXISTS, evaluated once at run
    time; neither a driver-side ``isEmpty`` nor a join.
    """
    return primary.unionByName(secondary.where(~primary.select(F.lit(1)).exists()), allowMissingColumns=True)


def pick_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key under a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
