"""Stupid-backoff language-model scores of documents, by counts of all n-grams.

Tokens are lower-cased words, all of them; each text begins after a ``<s>``.  N-grams of up to ``order`` words
are counted over all documents.  A word is scored by the longest n-gram ending there that another document has:

    (c(n-gram) - own) / (c(all but its last word) - own), times ``backoff`` for each word it is shorter than it could be,

else by ``max(c(w) - own, 1) / N``.  Each ``own`` is the document's count of just that n-gram, which would
otherwise vouch for its own text.

Documents are dealt into slices of about ``SLICE`` bytes by a hash.  A slice sends its distinct n-grams, each once with its
count, to buckets of n-grams; a bucket adds up the counts of all slices and returns to each what the others have.  So an
n-gram that very many documents have is one entry a slice, and neither a slice nor a bucket grows with the corpus.
Words and pairs are looked up together.  A document that holds an n-gram of another one holds its shorter parts of that
one too: so a longer n-gram is looked up only where another document has both its parts, and no count of one that two
documents have is lost.  Slices read their texts anew for each lookup, so only n-grams' keys and counts wait on disk.
Keys are sorted and sent as gaps, and both as compressed arrays.  N-grams and documents are told apart by 64-bit hashes.

Null, empty and blank texts have no tokens and a null score.  Rows equal in ``doc_id`` and
text are one document, returned once with their number as ``copies`` (each counts in the
corpus).  An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, tidy

ORDER, BACKOFF = 3, 0.4
#: Bytes of text of a slice, and bytes of text whose n-grams make a bucket; bytes that are hashed at once.
SLICE, BUCKET, BLOCK = 4 << 20, 4 << 20, 1 << 18
#: The keys of <s> and of the number of all words.
START, TOTAL = 0x5C17A9E3D2B48F60, 0x2E6D3B80F4A7915C
#: Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A word's bytes are digits of a number to this base, by random values; longer words have a hash of their own.
_BASE, _LONG = 0xD6E8FEB86659FD93, 64
_DIGITS = np.random.default_rng(7).integers(1 << 63, dtype=np.uint64, size=256)[np.frombuffer(_LOWER, np.uint8)] * np.uint64(2) + np.uint64(1)

PACKED = "slice int, bucket int, step int, n long, keys binary, counts binary"


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def _xxh64(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    return _mixed(_turned((seed + _P5 + np.uint64(8)) ^ (_turned(value * _P2, 31) * _P1), 27) * _P1 + _P4)


def joined_keys(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64(head, tail)`` gives, for arrays."""
    return _xxh64(tail, _xxh64(head, np.full(len(head), 42, np.uint64)))


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words of the texts, lower-cased, and the text each is in."""
    import xxhash

    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    edge = np.flatnonzero(np.diff(_GAP[data], prepend=True))        # a word begins, a word ends, ...
    begin, end = edge[::2], edge[1::2]
    up, down = _powers(1 << len(data).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_DIGITS[data] * up[:len(data)])])
    key = _mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _P5)
    for i in np.flatnonzero(end - begin > _LONG):
        key[i] = xxhash.xxh3_64_intdigest(joined[begin[i]:end[i]].translate(_LOWER))
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return key, np.searchsorted(starts, begin, "right") - 1


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The text and the place in it of <s> and each word, text by text, and for n = 1 to ``order`` the key of the n-gram
    ending there: that of a longer one is ``xxhash64`` of the keys of its words but the last and but the first, and
    at places less than n - 1 it has no meaning."""
    parts: list[list[np.ndarray]] = [[] for _ in range(order + 2)]
    at = 0
    while at < len(texts):
        till, size = at, 0
        while till < len(texts) and (till == at or size + len(texts[till]) <= BLOCK):
            size, till = size + len(texts[till]), till + 1
        word, text = hashed_words(texts[at:till])
        filled, many = np.unique(text, return_counts=True)
        first = np.cumsum(many + 1) - (many + 1)
        key = np.full(len(word) + len(filled), START, np.uint64)
        key[np.delete(np.arange(len(key)), first)] = word
        levels = [key]
        for _ in range(1, order):
            levels.append(np.concatenate([levels[-1][:1], joined_keys(levels[-1][:-1], levels[-1][1:])]))
        for p, x in zip(parts, (np.repeat(filled, many + 1) + at, np.arange(len(key)) - np.repeat(first, many + 1), *levels)):
            p.append(x)
        at = till
    doc, place, *keys = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
    return doc, place, [k.astype(np.uint64) for k in keys]


def stable_order(keys: np.ndarray) -> np.ndarray:
    """``np.argsort(keys, kind="stable")``: sorts the upper bits with the places as lower ones, then mends unlike keys with the same upper bits."""
    bits = np.uint64(max(len(keys) - 1, 1).bit_length())
    upper = keys >> bits << bits
    mixed = upper | np.arange(len(keys), dtype=np.uint64)
    mixed.sort()
    order = (mixed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    now = keys[order]
    wrong = np.flatnonzero(now[1:] < now[:-1])
    if len(wrong):
        tied = np.flatnonzero(np.isin(mixed >> bits, mixed[wrong] >> bits))
        order[tied] = order[tied][np.lexsort((order[tied], now[tied]))]
    return order


def packed(numbers: np.ndarray) -> bytes:
    """64-bit integers compressed byte by byte: all lowest bytes, all second ones, and so on; the upper ones of small numbers are zeros."""
    return pa.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kind: type = np.int64) -> np.ndarray:
    rows = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def _flags(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _rows(kinds: str, columns: list[list]) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [k.split() for k in kinds.split(", ")]
    return pa.table({name: pa.array(c, types[kind]) for (name, kind), c in zip(names, columns)})


def doc_key() -> Column:
    """One key for rows equal in id and text."""
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")


def merged(rows: pa.Table) -> pa.Table:
    """One row for each document, in the order of their keys, with the sum of ``copies``."""
    _, at, back = np.unique(rows["doc_key"].to_numpy(), return_index=True, return_inverse=True)
    copies = np.zeros(len(at), np.int64)
    np.add.at(copies, back, rows["copies"].to_numpy())
    return rows.take(pa.array(at)).drop_columns("copies").append_column("copies", pa.array(copies))


def sliced(docs: DataFrame, n: int) -> DataFrame:
    """slice, doc_key, doc_id, text, copies: equal rows of a batch are one already."""
    rows = docs.select(F.pmod(doc_key(), F.lit(n)).cast("int").alias("slice"), doc_key().alias("doc_key"), "doc_id", "text", F.lit(1).cast("long").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from merged(pa.Table.from_batches([batch])).to_batches()

    return rows.mapInArrow(run, rows.schema)


def steps(order: int) -> list[list[int]]:
    """The lengths that are looked up together."""
    return [[1, 2][:order], *[[n] for n in range(3, order + 1)]]


class Slice:
    """The documents of a slice, and how often other documents have their n-grams, as far as that has been looked up."""

    def __init__(self, rows: pa.Table, order: int):
        self.docs, self.order = merged(rows), order
        self.copies = self.docs["copies"].to_numpy()
        texts = [t or b"" for t in self.docs["text"].cast(pa.binary()).to_pylist()]
        self.doc, self.place, self.keys = grams(texts, order)
        self.others: list[np.ndarray] = []      # per length and place; 0 where no n-gram ends that another document could have
        self.total = 0

    def asked(self, lengths: list[int]) -> list[np.ndarray]:
        """The places of the n-grams to be looked up, per length."""
        out = []
        for n in lengths:
            ask = self.place >= n - 1
            if n > 2:
                shared = self.others[n - 2] > 0
                ask[1:] &= shared[1:] & shared[:-1]
            out.append(np.flatnonzero(ask))
        return out

    def distinct(self, lengths: list[int]) -> tuple:
        """The places asked for, their n-grams' order, the first of each in it, the distinct keys and their counts."""
        places = self.asked(lengths)
        key = np.concatenate([*[self.keys[n - 1][p] for n, p in zip(lengths, places)], np.full(int(1 in lengths), TOTAL, np.uint64)])
        doc = np.concatenate([*[self.doc[p] for p in places], np.zeros(int(1 in lengths), np.int64)])
        order = stable_order(key)
        key, doc = key[order], doc[order]
        first = np.flatnonzero(_flags(key))
        counts = np.add.reduceat(self.copies[doc], first) if len(first) else np.zeros(0, np.int64)
        if 1 in lengths:
            counts[np.searchsorted(key[first], np.uint64(TOTAL))] = self.copies[self.doc[self.place > 0]].sum()
        return places, order, key, doc, first, counts

    def learn(self, lengths: list[int], outside: np.ndarray) -> None:
        """Takes the counts that other slices have for the distinct n-grams."""
        places, order, key, doc, first, counts = self.distinct(lengths)
        counts = counts + outside
        if 1 in lengths:
            self.total = int(counts[np.searchsorted(key[first], np.uint64(TOTAL))])
        here = np.flatnonzero(_flags(key, doc))
        own = np.diff(here, append=len(key))
        left = np.empty(len(key), np.int64)
        left[order] = np.repeat(counts, np.diff(first, append=len(key))) - np.repeat(own, own)
        for p, x in zip(places, np.split(left, np.cumsum([len(p) for p in places]))):
            every = np.zeros(len(self.doc), np.int64)
            every[p] = x
            self.others.append(every)

    def scores(self, backoff: float) -> pa.Table:
        word = np.flatnonzero(self.place > 0)
        longest = np.minimum(self.place[word] + 1, self.order)
        penalty = float(np.log10(backoff))
        score = np.log10(np.maximum(self.others[0][word], 1) / max(self.total, 1)) + penalty * (longest - 1)
        alone = np.ones(len(word), bool)
        for n in range(2, self.order + 1):
            hit = np.flatnonzero(self.others[n - 1][word] > 0)
            at = word[hit]
            score[hit] = np.log10(self.others[n - 1][at] / self.others[n - 2][at - 1]) + penalty * (longest[hit] - n)
            alone[hit] = False
        doc, many = self.doc[word], len(self.copies)
        n_tokens = np.bincount(doc, minlength=many)
        blank = n_tokens == 0
        total = np.bincount(doc, score, minlength=many)
        return pa.table({
            "doc_id": self.docs["doc_id"], "n_tokens": n_tokens, "n_backoff": np.bincount(doc[alone], minlength=many),
            "log_score": pa.array(total, mask=blank), "mean_log_score": pa.array(total / np.maximum(n_tokens, 1), mask=blank), "copies": self.copies})


def summed(rows: pa.Table) -> pa.Table:
    """A bucket's n-grams, as slices sent them, to the counts that each slice's n-grams have in the other slices."""
    each = rows.select(["slice", "bucket", "step", "n", "keys", "counts"]).to_pylist()
    key = np.concatenate([np.cumsum(unpacked(r["keys"], r["n"], np.uint64)) for r in each])
    count = np.concatenate([unpacked(r["counts"], r["n"]) for r in each])
    order = np.argsort(key, kind="stable")      # quick, as it merges sorted runs
    first = np.flatnonzero(_flags(key[order]))
    outside = np.empty(len(key), np.int64)
    outside[order] = np.repeat(np.add.reduceat(count[order], first), np.diff(first, append=len(key)))
    parts = np.split(outside - count, np.cumsum([r["n"] for r in each])[:-1])
    return _rows(PACKED, [[r["slice"] for r in each], [r["bucket"] for r in each], [r["step"] for r in each], [r["n"] for r in each],
                          [None] * len(each), [packed(p) for p in parts]])


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_tokens, n_backoff (tokens scored by their word alone), log_score (sum of log10), mean_log_score, copies."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices, n_buckets = int(size // SLICE + 1), int(size // BUCKET + 1)
    lookups = steps(order)

    def read(rows: pa.Table, found: pa.Table | None, done: int) -> Slice:
        s = Slice(rows, order)
        answers = sorted(found.select(["step", "bucket", "n", "counts"]).to_pylist(), key=lambda r: r["bucket"]) if done else []
        for step in range(done):
            outside = [unpacked(r["counts"], r["n"]) for r in answers if r["step"] == step]
            s.learn(lookups[step], np.concatenate([np.zeros(0, np.int64), *outside]))
        return s

    def ask(rows: pa.Table, found: pa.Table | None, done: int) -> pa.Table:
        _, _, key, _, first, counts = read(rows, found, done).distinct(lookups[done])
        key = key[first]
        edges = [0, *np.searchsorted(key, np.array([(b << 64) // n_buckets for b in range(1, n_buckets)], np.uint64)), len(key)]
        sent = [(b, x, y) for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        return _rows(PACKED, [[rows["slice"][0].as_py()] * len(sent), [b for b, _, _ in sent], [done] * len(sent), [y - x for _, x, y in sent],
                              [packed(np.diff(key[x:y], prepend=np.uint64(0))) for _, x, y in sent], [packed(counts[x:y]) for _, x, y in sent]])

    def on_slices(found: DataFrame | None, done: int, run, kinds: str) -> DataFrame:
        dealt = sliced(docs, n_slices).groupBy("slice")
        if found is None:
            return dealt.applyInArrow(lambda rows: run(rows, None, done), kinds)
        return dealt.cogroup(found.groupBy("slice")).applyInArrow(lambda rows, known: run(rows, known, done), kinds)

    found = None
    for step in range(len(lookups)):
        asked = on_slices(found, step, ask, PACKED)
        answers = cut(asked.groupBy("bucket").applyInArrow(summed, PACKED).drop("keys"))
        # on executors of their own the last query's shuffles stay until another one has run, and the next lookup shuffles as much again
        docs.sparkSession.range(1).count()
        tidy(docs.sparkSession)
        found = answers if found is None else found.unionByName(answers)
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_backoff long, log_score double, mean_log_score double, copies long"
    return on_slices(found, len(lookups), lambda *given: read(*given).scores(backoff), kinds)
