"""Packing token sequences by first-fit decreasing, in randomised groups of documents.

A document's ids, then the end id, are cut in pieces of ``capacity`` ids and a last,
shorter one.  Documents are dealt to groups by a hash.  Within a group the pieces, the
longest first, go to the first sequence with room; a tournament tree over the
sequences' free capacities finds it in logarithmic time.  Only lengths and checksums
are shuffled, never ids.

Pieces reach a task sorted by group and length.  A task holds one group at a time, and
a group of more than ``max_pieces`` pieces (one document with millions of tokens, or
very many rows with the same ``doc_id`` and text) in parts of that size, each packed on its
own, so its memory is bounded.

Null text counts as empty: one piece with the end id alone.  Repeated rows are packed
each; an empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

_PROBE = "Probe: it's 12 xé日 <|endoftext|>\n\n  \t ends'll  "


class Encoder:
    """The ids that the ``tokenizers`` library gives for a byte-level BPE vocabulary.

    The same vocabulary as ranks lets tiktoken find the same ids several times faster; it
    is used if it agrees on a probe, and ``tokenizers`` itself for texts that it can't take.
    """

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(path), None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items() if t.special}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
            if self.ids(_PROBE).tolist() != self.plain(_PROBE):
                self.fast = None

    def plain(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except BaseException as e:     # its pattern engine gives up on endless runs of one character
                if isinstance(e, (KeyboardInterrupt, SystemExit)):
                    raise
        return np.array(self.plain(text), np.uint32)


@lru_cache(maxsize=2)
def _encoder(path: str, ranks_path: str | None, pattern: str | None) -> Encoder:
    return Encoder(path, ranks_path, pattern)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the given order, each in the first bin with room."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    free = [capacity] * (2 * leaves)       # free[i] is the larger of its two children: a tournament
    bins, offsets = [], []
    for n in lengths:
        i = 1
        while i < leaves:
            i = 2 * i if free[2 * i] >= n else 2 * i + 1
        bins.append(i - leaves)
        offsets.append(capacity - free[i])
        free[i] -= n
        while i > 1:
            i //= 2
            most = max(free[2 * i], free[2 * i + 1])
            if free[i] == most:
                break
            free[i] = most
    return bins, offsets


def pieces(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = 1024,
           end_id: int = 0) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, doc_crc32 of every piece; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, ranks_path, pattern)
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(text.as_py() or ""), end_id).astype("<u4")
                whole = zlib.crc32(ids.tobytes())
                for at in range(0, len(ids), capacity):
                    part = ids[at:at + capacity]
                    for column, value in zip(out, (doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids), whole)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), *[pa.array(c, pa.int64()) for c in out[1:]]],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_crc32"])

    bare = docs.select("doc_id", "text")
    kind = bare.schema["doc_id"].dataType.simpleString()
    return bare.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, doc_crc32 long")


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = 1024,
         end_id: int = 0, group_docs: int = 4096, max_pieces: int = 65_536, seed: int = 5) -> DataFrame:
    """Every piece with its sequence_id and offset.  A sequence's id holds its group in the upper 32 bits."""
    groups = max(1, -(-docs.count() // group_docs))
    cut_up = pieces(docs, path, ranks_path, pattern, capacity, end_id)
    kind = cut_up.schema["doc_id"].dataType.simpleString()
    dealt = (cut_up.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "doc_crc32"), F.lit(groups)).cast("long"))
             .drop("doc_crc32").repartition("group")
             .sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "ids_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, used = None, 0       # sequences used in this group so far

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used, held
            for part in pa.Table.from_batches(held).combine_chunks().to_batches() if held else ():
                bins, offsets = first_fit(part.column(2).to_pylist(), capacity)
                ids = (np.int64(group) << 32) + used + np.array(bins, np.int64)
                used += max(bins) + 1
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(ids), pa.array(offsets, pa.int64())],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            held = []

        for batch in batches:
            of = batch.column(5).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if of[lo] != group:
                    yield from packed()
                    group, used = int(of[lo]), 0
                while lo < hi:
                    room = max_pieces - sum(b.num_rows for b in held)
                    held.append(batch.slice(lo, min(room, hi - lo)))
                    lo += min(room, hi - lo)
                    if sum(b.num_rows for b in held) >= max_pieces:
                        yield from packed()
        yield from packed()

    return dealt.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
