"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit set if more than half of the hashes (XXH64, seed 42) of the
text's word shingles have it set; a text without words has fingerprint zero.

Rows are first reduced to distinct fingerprints, so a group of exact copies is one
row from there on; a fingerprint with very many copies is salted when rows get their ids.  A 64-bit fingerprint is cut in segments.  If two fingerprints
differ in at most ``r`` bits over ``m`` segments, then with ``q, s = divmod(r, m)`` one
of the first ``s + 1`` segments differs in at most ``q`` bits or another in at most
``q - 1``.  So the table holds every fingerprint under each segment's value, each
fingerprint looks up the Hamming ball of that radius around its own value, and the
full distance of every match is verified.

A segment value that more than ``max_bucket`` fingerprints share would match all of
them with all.  Such values leave the table, and the fingerprints that touch one (hold
it or look it up) are linked exactly in another way: each emits every value within
``r // 2`` bits (plus, for odd ``r``, its own neighbours one bit further), and those
that meet in a value are linked to the least of them in a star.  Two fingerprints
within ``r`` bits always meet halfway; those that meet are within ``r`` bits.  Rows
stay in proportion to fingerprints, whatever the size of a group.

Null and blank texts have fingerprint zero and link like any other.  Rows are never
merged in the result: repeated rows come back repeated.  A null ``doc_id`` is no
candidate for the smallest id; if all ids of a component are null, so is its id.  An
empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hot_keys, salted_join, slices
from .components import components

SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text, as an unsigned integer."""
    import xxhash

    w = (text or "").encode().translate(_LOWER).split()     # bytes.split() cuts at \x20 and \x09-\x0D only
    if not w:
        return 0
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(x), SEED) for x in zip(*(w[i:] for i in range(shingle)))), np.uint64, len(w) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        bits = np.unpackbits(h[at:at + 8192, None].view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(((ones * 2 > len(h)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns and fp (the fingerprint's 64 bits as a long) of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp)], [*carry, "fp"])

    bare = docs.select(F.col("text").alias("_text"), *carry)
    return bare.mapInArrow(run, T.StructType([*bare.schema.fields[1:], T.StructField("fp", T.LongType())]))


def ball(bits: int, radius: int) -> list[int]:
    """The masks of up to ``radius`` set bits among ``bits``, as signed 64-bit integers."""
    masks = [sum(1 << i for i in c) for n in range(radius + 1) for c in combinations(range(bits), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _segments(max_distance: int, m: int) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each segment that is looked up; a radius below 0 needs none."""
    q, s = divmod(max_distance, m)
    edges = [64 * i // m for i in range(m + 1)]
    return [(lo, hi - lo, q if i <= s else q - 1) for i, (lo, hi) in enumerate(zip(edges, edges[1:])) if i <= s or q > 0]


def _keys(max_distance: int, segments: int, looked_up: bool) -> Column:
    """Array of (segment, value) under which a fingerprint ``fp`` is held, or that it looks up."""
    def under(i: int, value: Column, masks: list[int]) -> Column:
        return F.transform(F.array(*[F.lit(x).cast("long") for x in masks]),
                           lambda x: F.struct(F.lit(i).alias("seg"), value.bitwiseXOR(x).alias("key")))

    parts = []
    for i, (shift, bits, radius) in enumerate(_segments(max_distance, segments)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
        parts.append(under(i, value, ball(bits, radius) if looked_up else [0]))
    return F.concat(*parts)


def links(distinct: DataFrame, max_distance: int = 2, segments: int = 2, max_bucket: int = 64) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct fingerprints ``fp`` within ``max_distance`` bits.

    From the index come all such pairs; of fingerprints in crowded buckets come stars that
    connect the same fingerprints.
    """
    table = distinct.select("fp", F.inline(_keys(max_distance, segments, False)))
    crowded = cut(table.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > max_bucket).select("seg", "key"))
    probes = distinct.select("fp", F.inline(_keys(max_distance, segments, True)))
    matched = (probes.withColumnRenamed("fp", "a").join(table.withColumnRenamed("fp", "b").join(crowded, ["seg", "key"], "left_anti"),
                                                        ["seg", "key"]))
    pairs = matched.where((F.col("a") != F.col("b")) & (distance("a", "b") <= max_distance)).select("a", "b")
    # every fingerprint that holds or looks up a crowded value; what it looks up includes what it holds
    touching = probes.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct()
    return pairs.unionByName(meeting(touching, max_distance))


def meeting(some: DataFrame, max_distance: int) -> DataFrame:
    """Stars that connect the fingerprints ``fp`` within ``max_distance`` bits of one another."""
    half, odd = divmod(max_distance, 2)
    places = ball(64, half)
    met = some.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in places])).alias("mask"))
    met = met.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("at"))
    if odd:     # one side goes a bit further: it meets every holder within the smaller radius
        more = some.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in ball(64, half + 1)])).alias("mask"))
        more = more.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("at"))
        # holders at one place within `half` bits of it are within max_distance of each other and of the visitor
        hub = met.groupBy("at").agg(F.min("fp").alias("hub"))
        return more.join(hub, "at").select(F.col("fp").alias("a"), F.col("hub").alias("b")).unionByName(
            met.join(hub, "at").select(F.col("fp").alias("a"), F.col("hub").alias("b"))).where("a <> b")
    hub = met.groupBy("at").agg(F.min("fp").alias("hub"), F.max("fp").alias("other")).where("hub <> other").select("at", "hub")
    return met.join(hub, "at").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def classes(docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int = 2, max_bucket: int = 64,
            carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Of every row the named columns, fp, component_id (the smallest doc_id reachable over links) and
    component (the least fingerprint reachable, which tells components apart even where ids repeat)."""
    rows = cut(fingerprints(docs, shingle, tuple(dict.fromkeys(("doc_id", *carry)))))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    total = distinct.agg(F.sum("copies")).first()[0] or 0
    linked = components(links(distinct.select("fp"), max_distance, segments, max_bucket), "a", "b")
    grouped = (linked.join(distinct, linked["node"] == distinct["fp"]).groupBy("component").agg(F.min("least").alias("least_linked"))
               .join(linked, "component").select(F.col("node").alias("fp"), "component", "least_linked"))
    ids = distinct.join(grouped, "fp", "left").select(
        "fp", F.when(F.col("component").isNotNull(), F.col("least_linked")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce("component", "fp").alias("component"))
    return salted_join(rows, ids, "fp", hot_keys(distinct, "fp", "copies", total)).select(*carry, "fp", "component_id", "component")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int = 2, max_bucket: int = 64) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the one with the least doc_id (null ids last);
    of rows with that id any one, the same on every run."""
    # the input travels as one struct, so its columns may have any names
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select("doc_id", "text", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), whole.alias("_doc"))
    found = classes(named.drop("_doc"), shingle, max_distance, segments, max_bucket, ("doc_id", "_row"))
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("_id"), F.col("best._row").alias("_best")).distinct()
    stay = named.join(best, named["doc_id"].eqNullSafe(best["_id"]) & (named["_row"] == best["_best"]), "left_semi")
    # only rows equal in all columns are left more than once
    return stay.dropDuplicates(["doc_id", "_row"]).select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
