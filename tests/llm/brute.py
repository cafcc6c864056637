"""Brute-force versions to hold the operators against."""

import hashlib
import re
import zlib
from itertools import combinations

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def quality(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(grams) < 3000 else \
        {i + j for g, at in _places(grams).items() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def _places(grams):
    out = {}
    for i, g in enumerate(grams):
        out.setdefault(g, []).append(i)
    return out


def simhash(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def simhash_components(rows, r=2):
    fps = sorted({f for _, f in rows})
    root = union([(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= r], fps)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f, least.get(root[f])) for i, f in rows), key=str)


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, rest = {}, set(order)
    while rest:
        left = sum(sizes.values()) - sum(full.values())
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}
        rest -= over
    return full


def assign_spans(text):
    kinds = {"assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
             "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)}
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, ok)) in enumerate(kinds.items()) for m in p.finditer(text or "") if ok(m)]
    return [x for *_, x in sorted(found)]
