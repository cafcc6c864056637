"""Token counts of whole texts by a SentencePiece model, huge texts chunk by chunk.

A text longer than ``chunk_bytes`` is never encoded at once.  Chunks that overlap
are encoded with offsets, and two neighbours are spliced at a boundary inside their
overlap that

* starts a token in both encodings, and
* is *proven stable*: it lies between a non-space character and a space, and no
  piece of the vocabulary holds a non-space character followed by the space marker.
  No merge can cross such a place, so the tokens on either side depend only on the
  text on that side.

If an overlap has no such boundary it is doubled; if it reaches back to the last
splice, the current chunk grows, at worst to the whole text (one endless word).
If the model's vocabulary or normaliser doesn't allow the proof, every text is
encoded whole.

Null text counts as empty: 0 bytes, 0 tokens.  Rows are independent: repeated rows
come back repeated, an empty table gives an empty result; only ``doc_id`` and
``text`` are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_list

MARK = "▁"   # SentencePiece's marker of a space


class Counter:
    """Exact token counts by one model; see the module docstring for long texts."""

    def __init__(self, model_path: str, chunk_bytes: int = 32_768, overlap_bytes: int = 512):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = chunk_bytes, overlap_bytes
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        probe = "a  b ﬁ ① é\t\n c"   # a normaliser that rewrites text would change these
        same = self.sp.decode(self.sp.encode(probe)) == probe
        self.provable = not crossing and same

    def counts(self, texts: list[str]) -> list[int]:
        short = [t if len(t) <= self.chunk or not self.provable else "" for t in texts]
        out = [len(ids) for ids in self.sp.encode(short, num_threads=1)]
        for i, t in enumerate(texts):
            if len(t) > self.chunk and self.provable:
                out[i] = self.spliced(t)
        return out

    @staticmethod
    def whole(data: bytes, at: int) -> int:
        """The last place up to ``at`` that splits no code point."""
        while 0 < at < len(data) and 0x80 <= data[at] < 0xC0:
            at -= 1
        return at

    def starts(self, data: bytes, lo: int, hi: int) -> np.ndarray:
        """Begin offsets, in bytes of the whole text, of the tokens of data[lo:hi]."""
        found = self.sp.encode(data[lo:hi].decode(), return_type="proto").pieces
        return np.fromiter((p.begin for p in found), np.int64, len(found)) + lo

    def spliced(self, text: str) -> int:
        data, space, mark = text.encode(), ord(" "), MARK.encode()
        n, total, done = len(data), 0, 0        # tokens that begin before `done` are counted
        lo, hi = 0, self.whole(data, min(n, self.chunk))
        here = self.starts(data, lo, hi)
        while hi < n:
            overlap = self.overlap
            while True:
                at = self.whole(data, max(done, hi - overlap))
                if at == done and overlap > self.overlap:   # the overlap is all of the open part: grow the chunk
                    hi = self.whole(data, min(n, hi + max(self.chunk, hi - lo)))
                    here = self.starts(data, lo, hi)
                    if hi == n:
                        break
                    overlap = self.overlap
                    at = self.whole(data, max(done, hi - overlap))
                end = self.whole(data, min(n, hi + self.chunk))
                there = self.starts(data, at, end)
                both = [b for b in np.intersect1d(here, there).tolist() if max(at, done) < b < hi
                        and data[b] == space and data[b - 1] != space and data[b - 3:b] != mark]
                if both:
                    splice = both[len(both) // 2]
                    total += int(((here >= done) & (here < splice)).sum())
                    done, lo, hi, here = splice, at, end, there
                    break
                overlap *= 2
        return total + int((here >= done).sum())


@lru_cache(maxsize=4)
def _counter(model_path: str, chunk_bytes: int, overlap_bytes: int) -> Counter:
    return Counter(model_path, chunk_bytes, overlap_bytes)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, chunk_bytes: int = 32_768,
                 overlap_bytes: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path, chunk_bytes, overlap_bytes)
        for batch in slices(batches):
            n = counter.counts(text_list(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    bare = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    kind = bare.schema["doc_id"].dataType.simpleString()
    return (bare.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
