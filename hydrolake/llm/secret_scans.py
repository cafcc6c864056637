"""Secrets in texts: fixed patterns, plus compression novelty near sensitive words.

Three patterns give the base spans (``assign``, ``access``, ``hex``; see PATTERNS).
The method adds spans of kind ``novel``: a candidate is a long run of key characters
of at least two character classes that touches no base span and has a sensitive word
on either side, anywhere on its line or within ``reach`` code points on other lines.  A run
that only punctuation and at most one line break separate from the run before inherits
that one's context, so the lines of a key and the segments of a JWT go together; the last,
short line of a PEM block goes with the line before it.  Its novelty is measured with Zstandard: a
compressor primed with a dictionary of common code identifiers compresses the
surrounding text with and without the candidate, and the difference, the candidate's
marginal bytes, is divided by its length.  Identifiers, words and repeats of nearby
text compress well; random keys don't, and are reported from ``min_novelty`` on.

Positions are code points, end exclusive.  Null and empty texts have no spans; rows
are independent, so repeated rows come back repeated and an empty table gives an
empty result.  The result's columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

KINDS = ("assign", "access", "hex", "novel")

# The base patterns; group 2 of the first must have 6 characters or more.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")       # the maximal runs of 24 or more
MIN_VALUE, MIN_ACCESS = 6, 20

#: Words that make their surroundings sensitive.
SENSITIVE = re.compile(r"passw|passphrase|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|"
                       r"bearer|authorization|auth[_-]|signature|session[ _-]?id|connection[ _-]?string", re.I | re.A)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
CLASSES = tuple(re.compile(c) for c in ("[0-9]", "[a-z]", "[A-Z]", "[+/_-]"))
#: What may stand between runs that belong together, and the short last line of a PEM block.
BETWEEN = " \t\r\n\"'`,;.+\\>|"
PEM_TAIL = re.compile(r"(?:[\s\"',>|]|\\[nr]?)*(?<![A-Za-z0-9+/])([A-Za-z0-9+/]{1,15}={0,2})(?:[\s\"'+,>|]|\\[nr]?)*-----END ")

#: The identifier dictionary that primes the compressor.
IDENTIFIERS = ("password passwd secret token api_key apikey access_key private_key credential authorization bearer "
               "signature session_id client_id client_secret username user_name connection_string database hostname "
               "localhost function return import export public static final string boolean integer default value "
               "config settings environment variable parameter request response header content_type application "
               "http:// https:// www. .com .org /usr/local/ /home/ example true false null none undefined "
               "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ -----BEGIN -----END").encode()


@lru_cache(maxsize=2)
def _compressor(level: int):
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False)


def novelty(before: str, candidate: str, after: str, level: int = 3) -> float:
    """Marginal compressed bytes of the candidate in its surroundings, per byte of its own."""
    z = _compressor(level)
    around = len(z.compress((before + after).encode()))
    return max(0, len(z.compress((before + candidate + after).encode())) - around) / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def near_sensitive(text: str, candidates: list[tuple[int, int]], reach: int) -> list[bool]:
    """Whether each candidate has a sensitive word beside it, or belongs to the one before that has."""
    marks = [m.span() for m in SENSITIVE.finditer(text)]
    if not marks:
        return [False] * len(candidates)
    starts, ends = [s for s, _ in marks], [e for _, e in marks]
    near, line, end, before = [], 0, -1, None
    for s, e in candidates:
        if s > end:
            line, end = text.rfind("\n", 0, s) + 1, text.find("\n", e)
            end = len(text) if end < 0 else end
        first, after = bisect_left(starts, min(line, s - reach)), bisect_left(starts, e)
        ok = first < len(marks) and ends[first] <= s or after < len(marks) and ends[after] <= max(end, e + reach)
        if not ok and before is not None and near[-1]:
            gap = text[before:s]
            ok = not gap.strip(BETWEEN) and gap.count("\n") <= 1
        near.append(ok)
        before = e
    return near


def spans(text: str, min_novelty: float = 0.6, reach: int = 48, around: int = 256) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then kind as listed."""
    found = base_spans(text)
    taken = sorted((s, e) for s, e, _ in found)
    candidates = [m.span() for m in CANDIDATE.finditer(text)]
    for (s, e), near in zip(candidates, near_sensitive(text, candidates, reach) if candidates else ()):
        if not near or sum(bool(c.search(text, s, e)) for c in CLASSES) < 2:
            continue
        if any(a < e and s < b for a, b in taken):
            continue
        if novelty(text[max(0, s - around):s], text[s:e], text[e:e + around]) >= min_novelty:
            found.append((s, e, "novel"))
            if (tail := PEM_TAIL.match(text, e)) and not any(a < tail.end(1) and tail.start(1) < b for a, b in taken):
                found.append((*tail.span(1), "novel"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def redacted(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with each stretch of touching spans replaced by ``[kind]`` of its first span."""
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("kind", T.StringType())]))
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), min_novelty: float = 0.6, reach: int = 48,
         around: int = 256) -> DataFrame:
    """``columns`` of every row and its ``secret_spans``; no shuffle."""
    keep = [c for c in columns if c != "secret_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[{"start": s, "end": e, "kind": k} for s, e, k in spans(t or "", min_novelty, reach, around)]
                     for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, _ARROW)], [*keep, "secret_spans"])

    bare = docs.select(F.col("text").alias("_scanned"), *keep)
    return bare.mapInArrow(run, T.StructType([*bare.schema.fields[1:], T.StructField("secret_spans", SPANS)]))


def redact(docs: DataFrame, min_novelty: float = 0.6, reach: int = 48, around: int = 256) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced; ``n_chars``, if there, is the new length."""
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = [t if not t else redacted(t, spans(t, min_novelty, reach, around)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        kind = schema["n_chars"].dataType
        changed = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out


def joined(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined in their order."""
    mine = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
