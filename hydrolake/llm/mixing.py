"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. A document's size is its number of words.  Sources, by code point with null last,
   weigh 1, 2, 3, repeating (or as given); they share all words by weight, but none
   gets more than ``max_epochs`` times its own, the excess being shared anew.
2. Within each source the documents stand in a seeded random order, end to end, and
   this stream of words is cut in as many blocks of at most ``block`` words as it needs, whose
   lengths differ by one word at most.
3. The mix has as many slots as the targets, rounded to words, need blocks.  Slot ``k`` of ``K`` has the
   golden-ratio point ``frac(k * g / K)``, ``g`` being the step next to ``K / phi`` that is coprime to ``K``, so the
   points are the multiples of ``1 / K``, each once, and evenly spread over any run of slots.  The sources' shares of the
   slots, cumulated, cut [0, 1); a slot goes to the source in whose part its point falls, and so every source gets just its slots.
4. A source's slots are ranked by their place ``k`` in the mix and take its blocks in turn, from the first again when all
   are used; the last slot takes what is left of the target.
5. Slots join documents on source and place in the stream; a document's share of the mix is what the
   chosen blocks hold of it, and its place that of its first block.

Positions in the streams are prefix sums over buckets, so a source
that holds most rows is spread over all tasks like any other.  The order depends on the
seed and the rows alone, so reruns and other cluster sizes give the same mix.

Null text has no words; documents without words take no part and get 0.  A null source is
a source of its own.  Repeated rows are documents of their own; those equal in ``doc_id``
and text stand next to each other, in either order.  With an empty table, or no words at
all, all targets are 0.  Only ``doc_id``, ``text`` and ``source`` are read, unless rows
are asked for; names of added columns start with an underscore.
"""

from __future__ import annotations

from decimal import Decimal, getcontext
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, cut, words
from .ranks import positions

WEIGHTS = (1, 2, 3)
BLOCK, MAX_EPOCHS, SEED = 64, 3, 17
#: Slots of a source that are made in one task at a time.
SLOT_BUCKET = 1 << 16


def golden_step(slots: int) -> int:
    """The step next to ``slots / phi`` that is coprime to ``slots``: its multiples visit every slot once."""
    getcontext().prec = 60
    near = int((Decimal(slots) * (Decimal(5).sqrt() - 1) / 2).to_integral_value())
    return next(g for d in range(slots + 1) for g in (near + d, near - d) if 0 < g <= max(1, slots) and gcd(g, slots) == 1)


def place_of(rank: Column, slots: int) -> Column:
    """The slot whose golden-ratio point is ``rank / slots``: the step's inverse turns points back to slots."""
    if slots < 2:
        return F.lit(0).cast("long")
    back = F.lit(pow(golden_step(slots), -1, slots)).cast("decimal(19,0)")
    return (rank.cast("decimal(19,0)") * back % F.lit(slots).cast("decimal(19,0)")).cast("long")


def prefix_sum(df: DataFrame, group: list[str], bucket: str, order: list[str], amount: str, out: str) -> DataFrame:
    """Sum of ``amount`` over the rows before each row in its group, by (bucket, order).

    The bucket totals are summed up over the few buckets of a group; the rows themselves only
    within their bucket, so no group is ever in one task.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(base, keys).withColumn(out, F.col("_base") + F.coalesce(F.sum(amount).over(within), F.lit(0)))
            .drop("_base"))


def source_key(source: Column) -> Column:
    """The source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target of (source, source_size).

    One row per source; all windows here are over this table of sources.
    """
    all_sources = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("_rank", F.row_number().over(all_sources.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = (ranked.withColumn("_w", weight).withColumn("_all", F.sum("source_size").over(all_sources))
              .withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
              .withColumn("_full_at", F.col("_cap") / F.col("_w")))
    # sources fill up in the order of _full_at; the level at which the rest stops is the first that none of them exceeds
    by_full = all_sources.orderBy("_full_at", "_rank")
    full = F.coalesce(F.sum("_cap").over(by_full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(by_full.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("_level", (F.col("_all") - full) / rest)
    level = level.withColumn("_stop", F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_rank", "_level")))
                             .over(all_sources))
    return level.withColumn("target", F.when(F.col("_stop").isNull(), F.col("_cap"))
                            .otherwise(F.least("_cap", F.col("_stop._level") * F.col("_w")))).select("source", "source_size", "target", "_rank")


def schedule(aims: DataFrame, block: int = BLOCK) -> DataFrame:
    """_src, _block, _epoch, _place, _first, _last of every slot: the block that it takes, for which time, its place in
    the mix, and from where to where in the source's stream."""
    wide = (aims.select(source_key(F.col("source")).alias("_src"), "_rank", F.col("source_size").alias("_n"), F.round("target").cast("long").alias("_aim"))
            .where("_aim > 0").withColumn("_blocks", F.ceil(F.col("_n") / block)))
    # the first _more blocks have a word more than the rest
    wide = wide.withColumn("_each", F.expr("_n div _blocks")).withColumn("_more", F.col("_n") % F.col("_blocks"))
    rest, longer = F.col("_aim") % F.col("_n"), F.col("_more") * (F.col("_each") + 1)
    part = F.when(rest <= longer, F.ceil(rest / (F.col("_each") + 1))).otherwise(F.col("_more") + F.ceil((rest - longer) / F.col("_each")))
    wide = wide.withColumn("_slots", F.expr("_aim div _n") * F.col("_blocks") + part)
    earlier = Window.partitionBy(F.lit(0)).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    wide = wide.withColumn("_before", F.coalesce(F.sum("_slots").over(earlier), F.lit(0)))
    wide = cut(wide)       # a row a source
    total = wide.agg(F.sum("_slots")).first()[0] or 0
    chunks = wide.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_slots - 1) div {SLOT_BUCKET}")))).repartition("_src", "_chunk")
    last = F.least((F.col("_chunk") + 1) * SLOT_BUCKET, F.col("_slots")) - 1
    # the ranks of the points in the source's part of [0, 1)
    slots = chunks.withColumn("_at", F.explode(F.sequence(F.col("_chunk") * SLOT_BUCKET, last)))
    slots = slots.select("_src", place_of(F.col("_before") + F.col("_at"), total).alias("_place"))
    ranked = positions(cut(slots), ["_src"], ["_place"]).select("_src", "_place", F.col("_pos").alias("_slot"))
    slots = ranked.join(wide.select("_src", "_n", "_aim", "_blocks", "_each", "_more").hint("merge"), "_src")
    slots = slots.withColumn("_block", F.col("_slot") % F.col("_blocks")).withColumn("_epoch", F.expr("_slot div _blocks"))
    at = lambda b: b * F.col("_each") + F.least(b, F.col("_more"))
    return slots.select("_src", "_block", "_epoch", "_place", at(F.col("_block")).alias("_first"),
                        F.least(at(F.col("_block") + 1), F.col("_aim") - F.col("_epoch") * F.col("_n")).alias("_last"))


def _streams(docs: DataFrame, carry: list[str], seed: int) -> DataFrame:
    """The rows with _src (their source's key), _size and _start, their place in the source's stream of words."""
    bits = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2)
    rows = docs.select(*([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_doc")] if "text" in carry else carry), source_key(F.col("source")).alias("_src"), F.size(words(F.col("text"))).cast("long").alias("_size"),
                       F.xxhash64(F.lit(seed), "doc_id", "text").alias("_order"), F.col("doc_id").alias("_id"))
    rows = rows.withColumn("_bucket", F.shiftrightunsigned("_order", 64 - bits))
    if "text" not in carry:     # without the texts the rows are small: count words once
        rows = cut(rows)
    return prefix_sum(rows, ["_src"], "_bucket", ["_order", "_id", "_size"], "_size", "_start")


def _aims(rows: DataFrame, max_epochs: int, weights) -> DataFrame:
    """The targets of the sources of these rows, one row per source."""
    sizes = rows.groupBy("_src").agg(F.sum("_size").alias("source_size"))
    source = F.when(F.col("_src") != "", F.substring("_src", 2, 1 << 30))
    return cut(targets(sizes.select(source.alias("source"), "source_size"), weights, max_epochs))


def _parts(rows: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """_src, _start, _epoch, _place, _lo, _hi: the words of a document that the chosen blocks hold, per time.

    Documents and slots meet in cells of ``block`` words of the stream; a slot touches two at most.
    """
    cells = lambda first, end: F.explode(F.sequence(F.floor(first / block), F.floor((end - 1) / block))).alias("_cell")
    end = F.col("_start") + F.col("_size")
    held = rows.where("_size > 0").select("_src", "_start", "_size", cells(F.col("_start"), end))
    taken = slots.select("_src", "_epoch", "_place", "_first", "_last", cells(F.col("_first"), F.col("_last")))
    cell = F.col("_cell") * block
    lo = F.greatest(cell, F.col("_start"), F.col("_first")) - F.col("_start")
    hi = F.least(cell + block, end, F.col("_last")) - F.col("_start")
    return held.join(taken, ["_src", "_cell"]).select("_src", "_start", "_epoch", "_place", lo.alias("_lo"), hi.alias("_hi")).where("_lo < _hi")


def mix_words(docs: DataFrame, block: int = BLOCK, max_epochs: int = MAX_EPOCHS, weights: tuple[float, ...] = WEIGHTS,
              seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_place of every row; ``first_place`` is the slot of
    the mix at which its words first come, null if none do."""
    rows = cut(_streams(docs, ["doc_id"], seed))
    aims = _aims(rows, max_epochs, weights)
    parts = _parts(rows, schedule(aims, block), block)
    taken = parts.groupBy("_src", "_start").agg(F.sum(F.col("_hi") - F.col("_lo")).alias("_taken"), F.min("_place").alias("first_place"))
    # a document without words shares its start with the next one, but takes nothing
    key = rows.withColumn("_key", F.when(F.col("_size") > 0, F.col("_start")))
    out = key.join(taken.withColumnRenamed("_start", "_key"), ["_src", "_key"], "left")
    # a source may hold most rows: they meet its target under one of several salts
    out = out.withColumn("_salt", F.pmod("_order", F.lit(SALTS)))
    told = aims.select(source_key(F.col("source")).alias("_src"), "source", "source_size", "target",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    return out.join(told, ["_src", "_salt"]).select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target",
                                                    F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"), "first_place")


def mix_rows(docs: DataFrame, block: int = BLOCK, max_epochs: int = MAX_EPOCHS, weights: tuple[float, ...] = WEIGHTS,
             seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    Within one time the chosen blocks of a source are consecutive, so a document is whole but
    for those where the schedule ends; of these the words taken remain (``n_chars`` to match).
    """
    carry = list(docs.columns)
    rows, light = _streams(docs, carry, seed), cut(_streams(docs, ["doc_id"], seed))
    aims = _aims(light, max_epochs, weights)
    parts = _parts(light, schedule(aims, block), block)
    times = parts.groupBy("_src", "_start", "_epoch").agg(F.min("_lo").alias("_from"), F.max("_hi").alias("_to"))
    got = rows.where("_size > 0").join(times, ["_src", "_start"])
    text = F.col("_doc.text")
    part = F.array_join(F.slice(words(text), (F.col("_from") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int")), " ")
    whole = (F.col("_from") == 0) & (F.col("_to") == F.col("_size"))
    got = got.withColumn("_text", F.when(whole, text).otherwise(part))
    out = {c: F.col("_doc").getField(c) for c in carry} | {"text": F.col("_text")}
    if "n_chars" in carry:
        out["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return got.select(*[value.alias(c) for c, value in out.items()])
