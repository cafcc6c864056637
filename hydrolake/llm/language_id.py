"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (lengths 1 to ``max_n``) of the lower-cased text, hashed
to ``n_features`` places and weighted by TF-IDF; document frequencies are counted over
all learnable documents.  The weights are learned by follow-the-regularised-leader
with elastic-net (L1 and L2) penalties, one document after the other, so most stay
exactly zero.  A temperature, fitted on documents kept out of that training, makes the
scores honest probabilities.

The classifier is fitted on a sample of at most ``per_language`` documents of each
language and ``max_sample`` in all (documented bounds); it is the only thing that
reaches the driver, with the document frequencies (one number a place).  Whole texts
are read, piece by piece, so a very long text needs no more memory than a short one.

Learnable are documents with a language, a text with a letter and an id that isn't held
out; a null id is held out.  Prediction sees the text alone.  A text that is null,
empty or without a letter gets ``und`` with score 0, as does any text if nothing was
learnable (an empty table gives an empty result).  Ties go to the language first by
code point.  Repeated rows come back repeated.  Only ``doc_id``, ``text`` and ``lang``
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, slices

UNKNOWN = "und"
N_FEATURES, MAX_N = 1 << 16, 3
PER_LANGUAGE, MAX_SAMPLE = 600, 20_000
#: Follow-the-regularised-leader: learning rate, its offset, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 0.05, 0.01, 3
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def term_counts(text: str, n_features: int = N_FEATURES, max_n: int = MAX_N, piece: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the text's n-grams, piece by piece."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    total = np.zeros(n_features, np.int64) if len(codes) * max_n > n_features // 4 else None
    shift, found = np.uint64(64 - (n_features.bit_length() - 1)), []
    for at in range(0, len(codes), piece):
        c = codes[at:at + piece + max_n - 1].astype(np.uint64)
        ends = min(piece, len(codes) - at)          # n-grams that begin in this piece
        h = np.zeros(len(c), np.uint64)
        for n in range(max_n):
            h = (h[:len(c) - n] if n == 0 else h[:-1] * _MIX[3]) + (c[n:] + np.uint64(1)) * _MIX[0]
            if not len(h):
                break
            x = h ^ (h >> np.uint64(29)) ^ np.uint64(n)
            places = ((x * _MIX[1]) >> shift)[:ends].astype(np.int64)
            if total is not None:
                total += np.bincount(places, minlength=n_features)
            else:
                found.append(places)
    if total is not None:
        where = np.flatnonzero(total)
        return where, total[where]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def tfidf(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[places]
    norm = np.sqrt((v * v).sum())
    return v / norm if norm > 0 else v


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, alpha: float = ALPHA,
             beta: float = BETA, l1: float = L1, l2: float = L2, passes: int = PASSES) -> np.ndarray:
    """Weights (features by classes) of a multinomial regression; rows: places, values, class."""
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))

    def weights(at) -> np.ndarray:
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(passes):
        for places, values, y in rows:
            w = weights(places)
            p = softmax(values @ w)
            p[y] -= 1
            g = values[:, None] * p
            g2 = g * g
            sigma = (np.sqrt(n[places] + g2) - np.sqrt(n[places])) / alpha
            z[places] += g - sigma * w
            n[places] += g2
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(y)), y]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    lo, hi, r = -5.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        places, counts = term_counts(text, len(self.idf))
        p = softmax(tfidf(places, counts, self.idf) @ self.weights[places] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def document_frequencies(texts: DataFrame, n_features: int) -> tuple[np.ndarray, int]:
    """In how many of the texts each place occurs, and the number of texts; summed in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(n_features, np.int64), 0
        for batch in slices(batches):
            for t in batch.column(0):
                if has_letter(t.as_py()):
                    seen[term_counts(t.as_py(), n_features)[0]] += 1
                    rows += 1
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(where, -1)), pa.array(np.append(seen[where], rows))], ["place", "n"])

    out, total = np.zeros(n_features, np.int64), 0
    for place, n in texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n")).toLocalIterator():
        if place < 0:
            total = n
        else:
            out[place] = n
    return out, total


def fit(docs: DataFrame, n_features: int = N_FEATURES, per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE) -> Model:
    """Learn from the documents that aren't held out."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id")) != HELD_OUT))
    seen, total = document_frequencies(known, n_features)
    if not total:
        return Model([], np.zeros(n_features), np.zeros((n_features, 0)), 1.0)
    idf = np.log((1 + total) / (1 + seen)) + 1

    n_languages = known.select("lang").distinct().count()
    each = max(1, min(per_language, max_sample // max(1, n_languages)))
    # the least hashes of each language: ranked without the texts, cut in each task before the shuffle
    ranked = known.select("doc_id", "lang", F.xxhash64(F.lit(3), "doc_id", "text").alias("at"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id"))).where(F.col("rank") <= each)
    chosen = ranked.orderBy("rank", "at", "doc_id").limit(max_sample).select(F.col("doc_id").alias("_id"), F.col("at").alias("_at"))
    # at most max_sample rows, so the texts themselves stay where they are
    hashed = known.withColumn("at", F.xxhash64(F.lit(3), "doc_id", "text"))
    picked = hashed.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("at") == F.col("_at")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            terms = [term_counts(t or "", n_features) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.tolist() for p, _ in terms], pa.list_(pa.int32())),
                 pa.array([c.tolist() for _, c in terms], pa.list_(pa.int32())), batch.column(2), batch.column(3)],
                ["lang", "places", "counts", "fold", "at"])

    sample = cut(picked.select("lang", "text", fold(F.col("doc_id")).alias("fold"), "at").mapInArrow(
        run, "lang string, places array<int>, counts array<int>, fold long, at long")).toArrow()
    languages = sorted(set(sample["lang"].to_pylist()))
    rows = sorted(zip(sample["at"].to_pylist(), sample["lang"].to_pylist(), sample["fold"].to_pylist(),
                      sample["places"], sample["counts"]), key=lambda r: r[:3])
    learn, check = [], []
    for _, lang, f, places, counts in rows:
        p = np.asarray(places.values)
        (check if f == CALIBRATION else learn).append((p, tfidf(p, np.asarray(counts.values), idf), languages.index(lang)))
    weights = fit_ftrl(learn or check, n_features, len(languages))
    check = check or learn
    logits = np.array([v @ weights[p] for p, v, _ in check])
    return Model(languages, idf, weights.astype(np.float32), fit_temperature(logits, np.array([y for *_, y in check])))


def identify(docs: DataFrame, model: Model | None = None, **bounds) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    learned = docs.sparkSession.sparkContext.broadcast(model or fit(docs, **bounds))    # features by languages: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            said = [learned.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([s for s, _ in said], pa.string()),
                                              pa.array([p for _, p in said], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    bare = docs.select("doc_id", "text", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(True)).alias("held_out"))
    return bare.mapInArrow(run, f"doc_id {bare.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
