"""MinHash fingerprints of documents, their likeness, and verified near-duplicate classes.

A fingerprint holds, for each of ``PERMUTATIONS`` universal hash functions, 16 bits of the
least hash of the text's word shingles (five words; a shorter text is one shingle, a
text without words has none).  The share of equal places of two fingerprints estimates
the Jaccard likeness of their shingle sets.

``classes`` finds texts whose Jaccard likeness is ``threshold`` or more.  Equal texts are one
node.  Signatures are cut in bands; nodes that share a band meet in a bucket, a group of a Spark
shuffle, and are candidates if the estimate of their likeness is at least ``CANDIDATE``, over
three standard deviations below the threshold.  The exact likeness of the shingle sets
decides about a pair.  That is done twice: first for each node and the likest it meets in a stretch
of its bucket, which links most groups; then for all candidate pairs that are still in different
components.  For these a bucket is cut in blocks of about ``BLOCK`` nodes, the nodes outside its
largest component visit each block, and the texts of those that have a candidate there follow, to
be compared in place: pairs are never rows, only links are, and one link joins two components.  A
pair that shares several bands belongs to the first.  So no bucket is gathered in a task, and no link
between components is left out.

``compare`` sets each document beside the next one by id.  Ids are cut in ranges at approximate
quantiles; a range is one bucket of a single shuffle, in which texts travel compressed and the
first document of a range goes to the range before as well.  Tasks read a bucket in order and
hold two documents at a time.

Null text counts as empty.  Texts without words equal one another (likeness 1) and no other.
Documents with a null id come last in the order; rows equal in id stand by their texts' hash.  A single
document is its own next one.  Repeated rows come back repeated; an empty table gives an
empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hot_keys, salted_join, slices, tidy
from .components import components

PERMUTATIONS, SHINGLE, THRESHOLD = 100, 5, 0.8
BANDS, BAND_ROWS = 20, 5        # at a likeness of 0.8 a pair misses all bands once in 3,000, at 0.9 once in 10 million
CANDIDATE, BLOCK = 0.65, 256
CELL, GUIDES = 16 * BLOCK, 8    # rows of a bucket that one task compares first, and rows of a larger bucket that all its cells see
_RANDOM = np.random.Generator(np.random.PCG64(20))
_A = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the text's word shingles, repeats included."""
    import xxhash

    w = text.encode().split()        # bytes.split() cuts at \x20 and \x09-\x0D only
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = min(shingle, len(h))
    if not n:
        return h
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * _STEP + h[i:len(h) - n + 1 + i]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def signature(text: str, shingle: int = SHINGLE) -> bytes:
    """16 bits of the least value of each permutation over the shingles; all ones for a text without words."""
    x, least = shingle_hashes(text, shingle), np.full(PERMUTATIONS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(x), 1024):
        least = np.minimum(least, (x[at:at + 1024, None] * _A + _B).min(axis=0))
    return ((least >> np.uint64(16)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)).mean())


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points of the next one, or all it has."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


def jaccard(a: str, b: str, shingle: int = SHINGLE) -> float:
    """Exact likeness of two texts' shingle sets; 1 if both are empty."""
    return set_jaccard(np.unique(shingle_hashes(a, shingle)), np.unique(shingle_hashes(b, shingle)))


def set_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def _node(text: Column) -> Column:
    """The first 16 bytes of the text's SHA-256: equal for equal texts only."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _bare(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), _node(text).alias("node"))


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, node, sig of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sig = [signature(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sig, pa.binary())], ["doc_id", "node", "sig"])

    bare = _bare(docs)
    return bare.mapInArrow(run, f"doc_id {bare.schema['doc_id'].dataType.simpleString()}, node binary, sig binary")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, packed (its compressed text) of the nodes asked for, once each.

    A broadcast table of hashed slots, at most 2**18 rows by construction, keeps most other
    texts out of the shuffle; the join that follows is exact.
    """
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << 18))

    slots = nodes.select(slot("node").alias("slot")).distinct()
    some = _bare(docs).withColumn("slot", slot("node")).join(F.broadcast(slots), "slot", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([z.compress(t.as_py().encode()) for t in batch.column(1)], pa.binary())],
                                             ["node", "packed"])

    # copies are made one in each task, before the shuffle: a text with very many copies is never gathered
    packed = some.select("node", "text").mapInArrow(run, "node binary, packed binary").groupBy("node").agg(F.first("packed").alias("packed"))
    return packed.join(nodes, "node", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """hub, node, d: the exact Jaccard distance of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in slices(batches, 128):
            d = [1 - jaccard(z.decompress(a.as_py()).decode(), z.decompress(b.as_py()).decode(), shingle)
                 for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d, pa.float64())], ["hub", "node", "d"])

    both = (pairs.join(texts, "node").withColumnRenamed("packed", "of_node")
            .join(texts.select(F.col("node").alias("hub"), F.col("packed").alias("of_hub")), "hub"))
    return both.select("hub", "node", "of_hub", "of_node").mapInArrow(run, "hub binary, node binary, d double")


def _shares(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Likeness of each signature of ``one`` to each of ``many``."""
    return np.stack([(many == x).mean(axis=1) for x in one]) if len(one) else np.zeros((0, len(many)))


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), PERMUTATIONS)


def _cells(size: str) -> Column:
    return F.ceil(F.col(size) / CELL)


def _likest(members: DataFrame) -> DataFrame:
    """a, b: each node and the likest candidate of its stretch of the bucket, in each bucket; members: key, size, node, sig.

    A bucket of more than CELL rows (``size``) is dealt out over cells by a hash of the node.  About GUIDES of its rows are
    shown to every cell, so that a family spread over the cells comes out as one component; what the cells miss, ``_across`` finds.
    """

    def pairs(table: pa.Table) -> pa.RecordBatch:
        node, sig = table.column("node").to_pylist(), _signature_rows(table.column("sig").combine_chunks())
        like = _shares(sig, sig)
        np.fill_diagonal(like, -1)
        best = like.argmax(axis=1)
        found = {tuple(sorted((node[i], node[k]))) for i, k in enumerate(best) if like[i, k] >= CANDIDATE}
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def told() -> Iterator[pa.RecordBatch]:
            if sum(b.num_rows for b in held) > 1:
                yield pairs(pa.Table.from_batches(held))

        for batch in batches:
            of, cell = batch.column("key").to_numpy(), batch.column("cell").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(of) != 0) | (np.diff(cell) != 0)) + 1).tolist(), len(of)] if len(of) else []
            for lo, hi in zip(edges, edges[1:]):
                if (of[lo], cell[lo]) != key:
                    yield from told()
                    key, held = (of[lo], cell[lo]), []
                while lo < hi:
                    room = BLOCK - sum(b.num_rows for b in held)
                    held.append(batch.slice(lo, min(room, hi - lo)))
                    lo += min(room, hi - lo)
                    if sum(b.num_rows for b in held) == BLOCK:      # the next stretch begins with the last row of this one
                        yield from told()
                        held = [held[-1].slice(held[-1].num_rows - 1)]
        yield from told()

    cells = _cells("size")
    own = F.array(F.pmod(F.xxhash64("node"), cells))
    guide = (cells > 1) & (F.pmod(F.xxhash64(F.lit(1), "node"), F.col("size")) < GUIDES)
    seen_by = F.when(guide, F.sequence(F.lit(0).cast("long"), cells - 1)).otherwise(own)
    dealt = members.select("key", "node", "sig", F.explode(seen_by).alias("cell"))
    ordered = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "node")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def _laid(rows: DataFrame) -> DataFrame:
    """Blocks whole and in order: first the nodes at home there, then the visitors."""
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "visits", "node")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Of each visitor: its row, and the rows at home in its block."""
    place, home = None, []
    for batch in slices(batches, 512):
        for row in batch.to_pylist():
            row["words"] = np.frombuffer(row["sig"], np.uint16)
            if (row["key"], row["block"]) != place:
                place, home = (row["key"], row["block"]), []
            if not row["visits"]:
                home.append(row)
            else:
                yield row, home


def _candidates(guest: dict, home: list[dict]) -> list[dict]:
    """Who at home may be near the guest, is in another component and shares no band before this one."""
    if not home:
        return []
    same = np.stack([r["words"] for r in home]) == guest["words"]
    near = np.flatnonzero(same.mean(axis=1) >= CANDIDATE)
    bands = same[near, :BANDS * BAND_ROWS].reshape(len(near), BANDS, BAND_ROWS).all(axis=2)
    first = bands.argmax(axis=1)
    return [home[k] for k, f in zip(near, first) if f == guest["band"] and home[k]["component"] != guest["component"]
            and (home[k]["visiting"] == 0 or home[k]["node"] < guest["node"])]      # two visitors meet in both their blocks


_PLACED = "key long, band int, block long, visits int, visiting int, node binary, sig binary, component binary"


def _across(members: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """a, b: links between components; members: key, size, band, node, sig, component."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    split = (sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"))
             .where("parts > 1").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"), F.col("most.component").alias("largest"),
                                        F.explode(F.sequence(F.lit(0).cast("long"), _cells("n") - 1)).alias("cell")))
    # a large bucket meets its one row of ``split`` in as many places as it has cells
    rows = members.withColumn("cell", F.pmod(F.xxhash64("node"), _cells("size"))).join(split, ["key", "cell"]).drop("cell").withColumn("visiting", (F.col("component") != F.col("largest")).cast("int"))
    shown = ("visiting", "node", "sig", "component")
    home = rows.select("key", "band", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.lit(0).alias("visits"), *shown)
    guests = rows.where("visiting = 1").select("key", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                                               F.lit(1).alias("visits"), *shown)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that have a candidate in their block."""
        names = [x.split()[0] for x in _PLACED.split(", ")]
        sent, place = set(), None

        def told(rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r[c] for r in rows]) for c in names]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names)

        out: list[dict] = []
        for guest, at_home in _blocks(batches):
            if (guest["key"], guest["block"]) != place:
                place, sent = (guest["key"], guest["block"]), set()
            found = _candidates(guest, at_home)
            fresh = [r for r in found if r["node"] not in sent]
            sent.update(r["node"] for r in fresh)
            out += fresh + ([guest] if found else [])
            if len(out) >= 512:
                yield told(out)
                out = []
        if out:
            yield told(out)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact comparison; a pair of components that one link has joined is not compared again in its block."""
        import zstandard

        z, place, up, sets = zstandard.ZstdDecompressor(), None, {}, {}

        def top(c: bytes) -> bytes:
            while up.get(c, c) != c:
                c = up[c]
            return c

        def shingles(row: dict) -> np.ndarray:
            if row["node"] not in sets:
                sets[row["node"]] = np.unique(shingle_hashes(z.decompress(row["packed"]).decode(), shingle))
            return sets[row["node"]]

        for guest, at_home in _blocks(batches):
            if (guest["key"], guest["block"]) != place:
                place, up, sets = (guest["key"], guest["block"]), {}, {}
            out = []
            for other in _candidates(guest, at_home):
                a, b = top(guest["component"]), top(other["component"])
                if a != b and set_jaccard(shingles(guest), shingles(other)) >= threshold - 1e-9:
                    up[max(a, b)] = min(a, b)
                    out.append((guest["node"], other["node"]))
            sets.pop(guest["node"], None)       # visitors pass; those at home stay
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    some = _laid(home.unionByName(guests)).mapInArrow(wanted, _PLACED)
    return _laid(some.join(texts, "node")).mapInArrow(linked, "a binary, b binary").distinct()


def distinct_texts(signed: DataFrame) -> DataFrame:
    """node, least (doc_id), sig, copies of every distinct text."""
    return cut(signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig"), F.count("*").alias("copies")))


def classes(docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """node, class_id: the least doc_id of each class, for every distinct text (``distinct_texts``)."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda i: F.xxhash64(i, F.substr(F.col("sig"), i * 2 * BAND_ROWS + 1, F.lit(2 * BAND_ROWS))))
    held = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    shared = held.groupBy("key").agg(F.min("node").alias("one"), F.max("node").alias("other"), F.count("*").alias("size"))
    shared = shared.where("one <> other").select("key", "size")
    members = cut(held.join(shared, "key").join(nodes.select("node", "sig"), "node"))
    texts = cut(_texts_of(docs, members.select("node").distinct()))

    d = _verified(_likest(members).select(F.col("a").alias("hub"), F.col("b").alias("node")), texts, shingle)
    first = cut(d.where(F.col("d") <= 1 - threshold + 1e-9).select(F.col("hub").alias("a"), F.col("node").alias("b")))
    grouped = members.join(components(first, "a", "b"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = components(first.unionByName(cut(_across(grouped, texts, threshold, shingle))), "a", "b")
    least = nodes.select("node", "least")
    ids = (found.join(least, "node").groupBy("component").agg(F.min("least").alias("class_id"))
           .join(found, "component").select("node", F.col("class_id").alias("linked"), F.lit(True).alias("has")))
    return least.join(ids, "node", "left").select("node", F.when(F.col("has"), F.col("linked")).otherwise(F.col("least")).alias("class_id"))


def compare(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """Of every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id."""
    signed = cut(signatures(docs, shingle))
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = signed.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q"), F.min("doc_id").alias("least")).first()
    edges = sorted({found["least"], *(found["q"] or [])} - {None})        # each is the id of a range's first document

    rows = signed.select("doc_id", "node").distinct()
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = distinct_texts(signed)
    hot = hot_keys(nodes, "node", "copies", signed.count())
    known = cut(salted_join(rows, classes(docs, nodes, threshold, shingle), "node", hot))
    del rows, signed, nodes, hot
    tidy(docs.sparkSession)
    known = known.select("doc_id", F.lit(None).cast("string").alias("text"), "node", "class_id")
    bare = _bare(docs).withColumn("class_id", F.lit(None).cast(kind)).unionByName(known)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, firsts = zstandard.ZstdCompressor(level=1), {e: i for i, e in enumerate(edges)}
        last = max(0, len(edges) - 1)
        for batch in slices(batches):
            ids = batch.column(0).to_pylist()
            packed = [None if t is None else z.compress(t.encode()) for t in batch.column(1).to_pylist()]
            take, place, part = [], [], []
            for i, x in enumerate(ids):
                take.append(i)
                place.append(last if x is None else int(np.searchsorted(edges, x, "right")) - 1)
                part.append(0 if packed[i] is None else 1)
                if x in firsts and packed[i] is not None:      # the first of a range follows the last of the one before
                    take.append(i)
                    place.append((firsts[x] - 1) % len(edges))
                    part.append(2)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int32()), pa.array(part, pa.int32()), batch.column(0).take(at), batch.column(2).take(at),
                 pa.array(packed, pa.binary()).take(at), batch.column(3).take(at)],
                ["place", "part", "doc_id", "node", "packed", "class_id"])

    laid = (bare.mapInArrow(dealt, f"place int, part int, doc_id {kind}, node binary, packed binary, class_id {kind}")
            .repartition("place")
            # a document's class comes just before it; what follows the range comes last
            .sortWithinPartitions("place", F.col("part") == 2, F.asc_nulls_last("doc_id"), "node", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, out = zstandard.ZstdDecompressor(), []
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"]
        types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), None]

        def told(doc, after) -> None:
            (doc_id, text, sig, group), (_, following, next_sig, _) = doc, after
            new = edited(text, following)
            new_sig = signature(new, shingle)
            out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), sig.hex(), new_sig.hex(),
                        likeness(sig, new_sig), likeness(sig, next_sig), group))

        def flush(schema: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array(c, t or schema.field("doc_id").type) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        place = before = first = group = schema = None
        for batch in slices(batches):
            schema = batch.schema
            for here, part, doc_id, node, packed, class_id in zip(*(c.to_pylist() for c in batch.columns)):
                if here != place:
                    if before:
                        told(before, first)
                    place, before, first, group = here, None, None, None
                if part == 0:
                    group = class_id
                    continue
                if part == 2 and not before:
                    continue
                text = z.decompress(packed).decode()
                doc = (doc_id, text, signature(text, shingle), group)
                if before:
                    told(before, doc)
                before, first = (doc if part == 1 else None), first or doc
            if out:
                yield flush(schema)
        if before:
            told(before, first)
        if out:
            yield flush(schema)

    return laid.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                f"near_edited double, near_next double, class_id {kind}")
