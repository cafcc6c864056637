"""Filter interaction audit over a sparse document-term matrix.

Five filters judge whole texts: A too few words, B too few different words, C too many capitals,
D symbols, E a copy of a text with a smaller doc_id.  For every order of the filters and every step
the audit counts, per source, what the filter keeps, removes, and would have removed had it come first.

1. Each task cuts its documents in shards of about ``shard_bytes`` of text, numbers the words of a
   shard in the order of their hashes and keeps the shard as a CSR block with those numbers
   (``shards``, written once, as Parquet).
2. A shard's words are dealt to buckets of the hash, packed, one row a shard and bucket.  A bucket
   numbers its words; prefix sums over the buckets make the numbers global (``dictionary``).  A word comes
   once a shard, so a frequent word is no hot key, and a bucket holds a bounded share of the words.
3. The numbers of a shard come back to it, bucket by bucket, behind its CSR block, which is
   rewritten with them (``matrix``).
4. Row sums of the blocks are the words of a document, their nonzero counts its different words:
   these decide A and B.  C and D were found when the text was read, E by the least doc_id of each
   text's SHA-256; the label flags are joined by doc_id.
5. Failures are 5 bits, so each source has at most 32 counters; all 120 orders follow from them.

Null text is empty: no words, so it fails A and B's shares are of nothing (0 < 0, no failure).  Null and
empty sources are one part, the empty string.  Rows with the same doc_id and text are no copies of each
other; a row without doc_id is never a copy and makes none.  Several label rows of a document count as one
that has any of their flags.  An empty table gives an empty result.  Only ``doc_id``, ``text``
and ``source`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, slices, tidy

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 2
SYMBOL = re.compile(rb"[#$%&*|]")
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
#: Words of all shards that a bucket numbers, on average.
BUCKET_WORDS = 1 << 19
_CAPITALS, _INNER = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
_BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


class _Numbers(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def packed_rows(indices: np.ndarray, data: np.ndarray, ends: np.ndarray) -> tuple[bytes, bytes]:
    """The columns of each row in order, as compressed differences, and their counts."""
    order = np.argsort(np.repeat(np.arange(len(ends) - 1), np.diff(ends)) << 32 | indices, kind="stable")
    ascending = indices[order].astype(np.int64)
    steps = np.diff(ascending, prepend=0)
    first = ends[:-1][np.diff(ends) > 0]
    steps[first] = ascending[first]
    squeeze = zstandard.ZstdCompressor(1).compress
    # equal bytes of the numbers side by side: the upper ones are nearly all zero
    return squeeze(steps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()), squeeze(data[order].astype("<i4").tobytes())


def unpacked_rows(indices: bytes, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress
    steps = np.frombuffer(raw(indices), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    sums = np.cumsum(steps)
    starts = ends[:-1][np.diff(ends) > 0]
    before = np.where(starts > 0, sums[starts - 1], 0) if len(starts) else np.zeros(0, np.int64)
    return sums - np.repeat(before, np.diff(ends)[np.diff(ends) > 0]), np.frombuffer(raw(data), "<i4")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


class _Shard:
    def __init__(self):
        self.words, self.size, self.rows = _Numbers(), 0, ([], [], [], [])
        self.indices, self.data, self.ends = [], [], [0]

    def add(self, doc_id, part: str, text: bytes) -> None:
        # bytes.split() without arguments splits at just the six blanks that part words
        found = Counter(text.split())
        self.indices.append(np.fromiter(map(self.words.__getitem__, found), np.int64, len(found)))
        self.data.append(np.fromiter(found.values(), np.int32, len(found)))
        self.ends.append(self.ends[-1] + len(found))
        capitals = len(text) - len(text.translate(None, _CAPITALS))
        points = len(text.translate(None, _INNER))      # UTF-8 bytes that begin a code point
        fails = (_BIT["C"] if 100 * capitals > MAX_CAPITAL_PERCENT * points else 0) | (_BIT["D"] if SYMBOL.search(text) else 0)
        for column, value in zip(self.rows, (doc_id, part, hashlib.sha256(text).digest(), fails)):
            column.append(value)
        self.size += len(text)

    def by_hash(self) -> tuple[bytes, bytes, bytes]:
        """The words in the order of their hashes, and the CSR block numbered so."""
        words = list(self.words)
        order = np.argsort(word_hashes(words), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        return b" ".join([words[i] for i in order]), *packed_rows(place[np.concatenate(self.indices)], np.concatenate(self.data), np.array(self.ends))


_CSR = "shard long, doc_id array<{kind}>, part array<string>, text_hash array<binary>, fails array<int>, ends array<int>, indices binary, data binary"


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """CSR blocks over each shard's own words, which stand in ``words``, joined by blanks, ``n_words`` of them."""
    bare = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    kind = bare.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, id_type = TaskContext.get().partitionId() << 32, _Shard(), None

        def done() -> pa.RecordBatch:
            nonlocal made, held
            ids, parts, hashes, fails = held.rows
            words, indices, data = held.by_hash()
            one = lambda values, of: pa.array([values], pa.list_(of))
            out = pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), one(ids, id_type), one(parts, pa.string()), one(hashes, pa.binary()), one(fails, pa.int32()),
                 one(held.ends, pa.int32()), pa.array([indices], pa.binary()), pa.array([data], pa.binary()), pa.array([words], pa.binary()),
                 pa.array([len(held.words)], pa.int64())],
                ["shard", "doc_id", "part", "text_hash", "fails", "ends", "indices", "data", "words", "n_words"])
            made, held = made + 1, _Shard()
            return out

        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.add(doc_id, part, text.as_py())
                if held.size >= shard_bytes or len(held.rows[0]) >= SHARD_DOCS:
                    yield done()
        if held.rows[0]:
            yield done()

    return bare.mapInArrow(run, _CSR.format(kind=kind) + ", words binary, n_words long")


def _numbered(local: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, ids (4-byte numbers within the bucket of the shard's words there, in their order); for
    each bucket also a row of shard -1 with its ``n`` words in ``words``, in the order of their numbers."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            words = batch.column(1)[0].as_py().split()
            of = (word_hashes(words).astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)      # ascends
            starts = np.flatnonzero(np.diff(of, prepend=np.uint64(buckets)))
            ends = [*starts[1:].tolist(), len(words)]
            yield pa.RecordBatch.from_arrays([pa.array(of[starts].astype(np.int64)), pa.array([batch.column(0)[0].as_py()] * len(starts), pa.int64()),
                                              pa.array([b" ".join(words[i:j]) for i, j in zip(starts.tolist(), ends)], pa.binary())],
                                             ["bucket", "shard", "words"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known = None, _Numbers()

        def out(shard: int, ids: bytes | None) -> pa.RecordBatch:
            last = ids is None
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([shard], pa.int64()), pa.array([ids], pa.binary()),
                                               pa.array([len(known) if last else None], pa.int64()), pa.array([b" ".join(known) if last else None], pa.binary())],
                                              ["bucket", "shard", "ids", "n", "words"])

        for batch in batches:
            for this, shard, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if this != bucket:
                    if bucket is not None:
                        yield out(-1, None)
                    bucket, known = this, _Numbers()
                own = words.as_py().split()
                yield out(shard, np.fromiter(map(known.__getitem__, own), "<i4", len(own)).tobytes())
        if bucket is not None:
            yield out(-1, None)

    dealt = local.select("shard", "words").mapInArrow(deal, "bucket long, shard long, words binary")
    # by shard within the bucket, so a task that runs again gives the same numbers
    return (dealt.repartition("bucket").sortWithinPartitions("bucket", "shard")
            .mapInArrow(number, "bucket long, shard long, ids binary, n long, words binary"))


def matrix(docs: DataFrame, shard_bytes: int = SHARD_BYTES, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """CSR shards of the document-term matrix over global word numbers, and their dictionary.

    A shard's row i has the columns ``indices[ends[i]:ends[i + 1]]`` (8-byte integers) and their counts in ``data`` (4-byte
    ones).  The dictionary has a row a bucket: ``base`` and its ``n`` words, joined by blanks, numbered from there.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "term-matrix")
    shards(docs, shard_bytes).write.option("compression", "zstd").parquet(f"{path}/shards")
    local = spark.read.parquet(f"{path}/shards")
    total = local.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_words))
    _numbered(local, buckets).write.option("compression", "zstd").parquet(f"{path}/numbers")
    tidy(spark)
    numbers = spark.read.parquet(f"{path}/numbers")
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)      # a row a bucket
    dictionary = numbers.where("shard = -1").select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("base"), "n", "words")

    kept = ["doc_id", "part", "text_hash", "fails", "ends"]
    csr = local.select("shard", F.lit(-1).cast("long").alias("bucket"), *kept, "indices", "data")
    told = numbers.where("shard >= 0").join(dictionary.select("bucket", "base"), "bucket").select("shard", "bucket", "ids", "base")
    rows = (csr.unionByName(told, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "bucket")
            .select("shard", *kept, "indices", "data", "ids", "base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, numbers = None, []

        def done() -> pa.RecordBatch:
            ends = head.column(5)[0].values.to_numpy()
            local_numbers, data = unpacked_rows(head.column(6)[0].as_py(), head.column(7)[0].as_py(), ends)
            ids = np.concatenate([np.zeros(0, np.int64), *numbers])[local_numbers]
            return pa.RecordBatch.from_arrays([*(head.column(i) for i in range(6)), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                                               pa.array([data.tobytes()], pa.binary())], ["shard", *kept, "indices", "data"])

        for batch in slices(batches, 1):
            if batch.column(8)[0].is_valid:
                numbers.append(np.frombuffer(batch.column(8)[0].as_py(), "<i4").astype(np.int64) + batch.column(9)[0].as_py())
            else:       # the block itself, before its numbers
                if head is not None:
                    yield done()
                head, numbers = batch, []
        if head is not None:
            yield done()

    kind = local.schema["doc_id"].dataType.elementType.simpleString()
    return rows.mapInArrow(run, _CSR.format(kind=kind)), dictionary


def judged(csr: DataFrame) -> DataFrame:
    """doc_id, part, text_hash, n_words, n_distinct, fails (A to D, a bit each) of every row of the matrix."""
    kind = csr.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, parts, hashes, fails, ends = (batch.column(i).flatten() for i in range(1, 6))
            ends, fails, data = ends.to_numpy(), fails.to_numpy(), np.frombuffer(batch.column(7)[0].as_py(), "<i4")
            below = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
            n_words, n_distinct = np.diff(below[ends]), np.diff(ends).astype(np.int64)
            fails = fails | np.where(n_words < MIN_WORDS, _BIT["A"], 0) | np.where(100 * n_distinct < MIN_DISTINCT_PERCENT * n_words, _BIT["B"], 0)
            yield pa.RecordBatch.from_arrays([ids, parts, hashes, pa.array(n_words), pa.array(n_distinct), pa.array(fails.astype(np.int32))],
                                             ["doc_id", "part", "text_hash", "n_words", "n_distinct", "fails"])

    return csr.mapInArrow(run, f"doc_id {kind}, part string, text_hash binary, n_words long, n_distinct long, fails int")


def counters(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (A to E), n, good, toxic: how many documents of a part fail just these filters."""
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = rows.select("doc_id", "part", "text_hash", "fails").join(flags, "doc_id", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # rows alike in all that counts are added up first, in the tasks that read them: a text with very
    # many copies, or a row repeated very often, is a few rows from here on
    alike = ["text_hash", "part", "fails", "good", "toxic"]
    same = known.groupBy(*alike, "doc_id").agg(F.count(F.lit(1)).alias("c"))
    groups = cut(same.groupBy(*alike).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("c"))).alias("ided"),
                                          F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c"))).alias("first")))
    least = groups.groupBy("text_hash").agg(F.min("first.doc_id").alias("least"))
    own = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.c")).otherwise(F.lit(0))
    split = groups.join(least, "text_hash").withColumn("copies", F.coalesce(F.col("ided") - own, F.lit(0)))
    each = split.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("fails").alias("fails"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("fails").bitwiseOR(F.lit(_BIT["E"])).alias("fails"), F.col("copies").alias("n")))))
    number = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(F.lit(0)))
    return each.where("n > 0").groupBy("part", "fails").agg(F.sum("n").alias("n"), number("good").alias("good"), number("toxic").alias("toxic"))


def _steps() -> str:
    """Every order and step: the filter's bit and the bits of those before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            out.append({"filter_order": "".join(order), "step": i + 1, "bit": _BIT[f], "before": before})
            before |= _BIT[f]
    return json.dumps(out)


def interactions(counted: DataFrame) -> DataFrame:
    """The audit's rows from the counters: every part in every order at every step."""
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))     # at most 32
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order string, step int, bit int, before int>>")
    rows = cells.select("part", "cells", F.inline(steps))
    bit, before = F.col("bit"), F.col("before")

    def add(value, chosen) -> Column:
        return F.aggregate(F.filter("cells", chosen), F.lit(0).cast("long"), lambda s, c: s + value(c))

    fails = lambda c: c["fails"].bitwiseAND(bit) != 0
    earlier = lambda c: c["fails"].bitwiseAND(before) != 0
    here = lambda c: fails(c) & ~earlier(c)
    n = lambda c: c["n"]
    # of the 120 orders a document is removed by one of its k failing filters in 120 / k
    turns = F.lit(len(list(permutations(FILTERS))))
    return rows.select(
        "part", "filter_order", "step", add(n, lambda c: ~fails(c) & ~earlier(c)).alias("kept"), add(n, here).alias("removed"),
        add(n, lambda c: fails(c) & earlier(c)).alias("redundant"), add(n, lambda c: c["fails"] == bit).alias("unique_fails"),
        add(lambda c: c["good"], here).alias("good_lost"), add(lambda c: c["toxic"], here).alias("toxic_lost"),
        add(lambda c: c["n"] * F.floor(turns / F.bit_count(c["fails"])).cast("long"), fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    csr, words = matrix(docs, shard_bytes)
    rows = cut(judged(csr))
    del csr, words
    tidy(docs.sparkSession)
    return interactions(counters(rows, labels))
