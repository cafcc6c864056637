"""Operators over the whole corpus: mixing, language, fingerprints, packing, scores, chat, near copies."""

import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import brute
from .conftest import DOCS

SAMPLE = "/root/testdata/sf0.001"


def near_copies(n=40, seed=2):
    """Texts of random words, with exact and near copies; ids are shuffled."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefghij", k=4))
    texts = [" ".join(word() for _ in range(rnd.randint(1, 90))) for _ in range(n)]
    for i in range(0, n, 3):
        w = texts[i].split()
        for _ in range(rnd.randint(1, 4)):
            w[rnd.randrange(len(w))] = word()
            texts.append(" ".join(w))
        texts += [texts[i], texts[i].upper()]
    texts += [None, "", " \n", "one", "One"]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts))


# mixing

def test_mixing_targets_and_taken(spark, docs_of):
    from hydrolake.llm import mixing as m

    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), None, rnd.choice(["a", "b", "é", None, "hot", "hot", "hot", "\U0001F600"])) for i in range(400)]
    rows += [(400, " ".join(["w"] * 9000), None, "hot"), (401, None, None, "tiny"), (402, "w", None, "tiny"), (402, "w", None, "tiny")]
    df = docs_of(rows, clashes=True)
    got = m.mix_words(df, block=8).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = brute.targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 24 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, m.mix_words(df.repartition(7), block=8).collect()))
    # the rows of the mix hold just the words taken
    mix = m.mix_rows(df, block=8)
    assert mix.columns == df.columns
    by_source = {r.source: r.n for r in mix.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    assert by_source == {s: n for s, n in taken.items() if n}
    assert mix.where("n_chars <> length(text) or target <> 'x_target'").count() == 0


def test_mixing_points_decide_the_slots(spark):
    """Every slot's golden-ratio point, put through the cumulative shares, gives its source; ranks give its block."""
    from hydrolake.llm import mixing as m

    sizes = {"a": 1000, "b": 6400, "c": 777, "d": 3}
    aims = m.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = sorted((r._place, r._src[1:], r._block, r._epoch, r._last - r._first) for r in m.schedule(aims, block=64).collect())
    slots = Counter(r[1] for r in got)
    total = sum(slots.values())
    g = m.golden_step(total)
    assert [r[0] for r in got] == list(range(total)) and math.gcd(g, total) == 1 and abs(g / total - 0.618) < 0.03
    edges, seen = {}, Counter()
    for s in sorted(sizes):
        edges[s] = (sum(edges[x][1] - edges[x][0] for x in edges), sum(edges[x][1] - edges[x][0] for x in edges) + slots[s])
    for k, source, block, epoch, _ in got:
        point = k * g % total           # of `total`
        assert next(s for s, (lo, hi) in edges.items() if lo <= point < hi) == source
        blocks = -(-sizes[source] // 64)
        assert (block, epoch) == (seen[source] % blocks, seen[source] // blocks)
        seen[source] += 1
    want = brute.targets(sizes)
    assert all(sum(r[4] for r in got if r[1] == s) == round(want[s]) for s in sizes)
    # large numbers of slots keep their exact places
    n, k = 10 ** 12 + 39, 123_456_789_012
    rank = k * m.golden_step(n) % n
    assert spark.range(1).select(m.place_of(F.lit(rank), n)).first()[0] == k


def test_stages_keep_columns_of_any_name(spark, docs_of):
    from hydrolake.llm import mixing as m
    from hydrolake.llm import simhash_dedup as d

    names = ("_row", "_src", "_size", "_order", "_id", "_base", "_epoch", "_from", "_to", "_start", "_bucket", "_doc", "_text", "_place", "_best", "component", "fp")
    df = docs_of([(i, f"word{i} " * 40, None, "a" if i % 3 else "b") for i in range(30)]).withColumns({c: F.concat(F.lit(f"{c}:"), "doc_id") for c in names})
    for out in (d.keep_one(df), m.mix_rows(df)):
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in names)


def test_mixing_gives_small_sources_their_targets(spark, docs_of):
    """At the full block size: sources far smaller than a block, one word longer and others, all to the word."""
    from hydrolake.llm import mixing as m

    sizes = {f"s{n:03}_{i}": n for n in (1, 5, 12, 30, 63, 64, 65, 70, 100, 129, 200) for i in range(3)} | {f"z{i}": 20000 for i in range(3)}
    rows = [(i, " ".join(["w"] * (size - size // 3 if half else size // 3)), None, s) for i, ((s, size), half) in
            enumerate((x, half) for x in sizes.items() for half in (0, 1))]
    for weights in ((1, 2, 3), (1, 50, 700, 0.002)):
        want, taken = brute.targets(sizes, weights), defaultdict(int)
        for r in m.mix_words(docs_of(rows), weights=weights).collect():
            taken[r.source] += r.taken
        assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
        mix = m.mix_rows(docs_of(rows), weights=weights).collect()
        for r in mix:
            taken[r.source] -= len(r.text.split())
        assert not any(taken.values())
    # the slots of a source are spread evenly over the mix
    aims = m.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    slots = [(r._src, r._place) for r in m.schedule(aims).collect()]
    points = sorted(p / len(slots) for s, p in slots if s == "=z1")
    assert all(abs(p - i / len(points)) < 0.02 for i, p in enumerate(points))


def test_mixing_without_words(spark, docs_of):
    from hydrolake.llm import mixing as m

    got = m.mix_words(docs_of([(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 2
    assert m.mix_words(docs_of([])).count() == 0 and m.mix_rows(docs_of([])).count() == 0


# language

def test_language_held_out_accuracy(spark, docs_of, odd):
    from hydrolake.llm import language_id as g

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in g.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if brute.held_out(i)]
    assert all(got[i].held_out == brute.held_out(i) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    # labels of held-out documents and the sources are never read
    blind = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.col("lang"))).withColumn("source", F.lit("x"))
    assert {(r.doc_id, r.lang_pred, r.score) for r in g.identify(blind).collect()} == {(r.doc_id, r.lang_pred, r.score) for r in got.values()}
    rows = g.identify(odd).collect()
    assert len(rows) == odd.count() and all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (0, 1, 2, 4))
    assert {r.lang_pred for r in g.identify(docs_of([(1, "text", None)])).collect()} == {"und"}
    assert g.identify(docs_of([])).count() == 0


def test_language_pieces_count_every_ngram():
    from hydrolake.llm import language_id as g

    text = "Éa bc日d" * 900
    whole, parts = g.term_counts(text), g.term_counts(text, piece=100)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    n = len(text.lower())
    assert whole[1].sum() == n + n - 1 + n - 2


def test_language_temperature_and_sparsity():
    from hydrolake.llm import language_id as g

    rnd = np.random.default_rng(1)
    rows = [(np.array([y, 2 + rnd.integers(50)]), np.array([1.0, 0.3]), int(y)) for y in rnd.integers(0, 2, 300)]
    w = g.fit_ftrl(rows, 1000, 2, l1=0.5)
    assert w[0, 0] > 0 > w[0, 1] and (w[60:] == 0).all() and (w != 0).mean() < 0.1
    logits = rnd.normal(size=(4000, 3))
    y = np.array([rnd.choice(3, p=p) for p in g.softmax(logits)])
    assert abs(g.fit_temperature(logits * 4, y) - 4) < 0.6


def test_language_equals_plain_python(spark, docs_of):
    """Document frequencies, TF-IDF, every step of the leader's path, the temperature and the predictions, number by number."""
    from hydrolake.llm import language_id as g

    rnd, size = random.Random(4), 1 << 12
    alphabet = {"xx": "abcde ", "yy": "defgh ", "zz": "hijka "}
    rows = [(i, "".join(rnd.choices(alphabet[lang], k=40)), lang) for i, lang in enumerate(rnd.choices(list(alphabet), k=70))]
    rows += [(100, None, "xx"), (101, "12 34", "yy"), (102, "abc", None)]
    terms = {i: dict(zip(*(x.tolist() for x in g.term_counts(t, size)))) if t else {} for i, t, _ in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, *_ in rows}
    known = [(i, lang) for i, t, lang in rows if lang and t and any(c.isalpha() for c in t) and fold[i]]
    seen = Counter(p for i, _ in known for p in terms[i])

    def values(i):
        v = {p: (1 + math.log(c)) * (math.log((1 + len(known)) / (1 + seen[p])) + 1) for p, c in terms[i].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {p: x / norm for p, x in v.items()}

    langs, z, n = ["xx", "yy", "zz"], Counter(), Counter()

    def weight(p, k):
        if abs(z[p, k]) <= g.L1:
            return 0.0
        return -(z[p, k] - math.copysign(g.L1, z[p, k])) / ((g.BETA + math.sqrt(n[p, k])) / g.ALPHA + g.L2)

    def chances(v, temperature=1.0):
        e = [math.exp(sum(x * weight(p, k) for p, x in v.items()) / temperature) for k in range(3)]
        return [x / sum(e) for x in e]

    order = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").select("doc_id", F.xxhash64(F.lit(3), "doc_id", "text").alias("at"))
    at = {r.doc_id: r.at for r in order.collect()}
    known.sort(key=lambda k: at[k[0]])
    for _ in range(g.PASSES):
        for i, lang in known:
            if fold[i] != g.CALIBRATION:
                v = values(i)
                p = chances(v)
                step = [((f, k), x * (p[k] - (langs[k] == lang)), weight(f, k)) for f, x in v.items() for k in range(3)]
                for key, grad, w in step:
                    z[key] += grad - (math.sqrt(n[key] + grad * grad) - math.sqrt(n[key])) / g.ALPHA * w
                    n[key] += grad * grad
    docs = docs_of(rows)
    model = g.fit(docs, n_features=size)
    assert model.languages == langs and len(z) > 300
    assert all(math.isclose(model.weights[p, k], weight(p, k), rel_tol=1e-4, abs_tol=1e-6) for p, k in z)
    check = [(values(i), langs.index(lang)) for i, lang in known if fold[i] == g.CALIBRATION]

    def loss(t):
        return -sum(math.log(max(chances(v, t)[y], 1e-12)) for v, y in check) / len(check)

    assert loss(model.temperature) <= min(loss(math.exp(x / 10)) for x in range(-50, 31)) + 1e-6
    got = {r.doc_id: r for r in g.identify(docs, n_features=size).collect()}
    for i, t, _ in rows:
        if not t or not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        else:
            p = chances(values(i), model.temperature)
            assert got[i].lang_pred == langs[p.index(max(p))] and math.isclose(got[i].score, max(p), rel_tol=1e-3)


# fingerprints

def test_signature_equals_plain_minhash():
    import xxhash

    from hydrolake.llm import fingerprints as f

    full = (1 << 64) - 1
    for text in ("", " ", "one", "a b c d e", "a b c d e f g a b c d e f g", " ".join(f"w{i % 700}" for i in range(3000))):
        w = [xxhash.xxh64_intdigest(x) for x in text.encode().split()]
        k = min(5, len(w))
        hashes = set()
        for i in range(len(w) - k + 1 if k else 0):
            h = 0
            for x in w[i:i + k]:
                h = (h * 0x9E3779B97F4A7C15 + x) & full
            h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & full
            hashes.add(h ^ (h >> 29))
        least = [min(((h * int(a) + int(b)) & full for h in hashes), default=full) for a, b in zip(f._A, f._B)]
        assert f.signature(text) == b"".join((x >> 16 & 0xFFFF).to_bytes(2, "little") for x in least)


def test_fingerprints_and_next_documents(spark, docs_of):
    from hydrolake.llm import fingerprints as f

    rows = near_copies()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = {r.doc_id: r for r in f.compare(docs_of(rows, clashes=True)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    text = {i: t or "" for i, t in rows}
    ids = sorted(text)
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        following = text[ids[(k + 1) % len(ids)]]
        new = f.edited(text[i], following)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text[i]), brute.sha(new))
        assert r.fingerprint == f.signature(text[i]).hex() and r.edited_fingerprint == f.signature(new).hex()
        assert abs(r.near_edited - brute.jaccard(text[i], new)) < 0.25 and abs(r.near_next - brute.jaccard(text[i], following)) < 0.25
        assert r.near_next == f.likeness(bytes.fromhex(r.fingerprint), bytes.fromhex(got[ids[(k + 1) % len(ids)]].fingerprint))
    root = brute.union([(a, b) for a in ids for b in ids if a < b and brute.jaccard(text[a], text[b]) >= 0.8], ids)
    assert {i: got[i].class_id for i in ids} == root


def test_fingerprint_classes_of_a_large_chain(spark, docs_of):
    """Each text is near its neighbours only: hubs must not tear the chain apart."""
    from hydrolake.llm import fingerprints as f

    w = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w[3 * i:3 * i + 100])) for i in range(60)]       # neighbours share 93 of 99 shingles
    got = f.compare(docs_of(rows)).collect()
    assert {r.class_id for r in got} == {0}


def test_fingerprint_odd_rows(spark, docs_of, odd):
    from hydrolake.llm import fingerprints as f

    got = f.compare(odd).collect()
    assert len(got) == odd.count()
    assert f.compare(docs_of([])).count() == 0
    alone = f.compare(docs_of([(5, "a b c d e f")])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == brute.sha("a b c a b c")     # 6 code points and the first 5
    nulls = f.compare(docs_of([(None, "x"), (None, "y")])).collect()
    assert len(nulls) == 2 and all(r.class_id is None for r in nulls)


# packing

def test_packing_is_exact(spark, docs_of, odd):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    from hydrolake.llm import packing as k

    path = p.path("byte_bpe_50k.json")
    slow = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").unionByName(docs_of([
        (10**6, "<|endoftext|> a <|endoftext|>"), (10**6 + 1, None), (10**6 + 2, "\n \n  é日\U0001F600 it's"), (10**6 + 3, "z" * 3000)]).select("doc_id", "text"))
    got = k.pack(docs, path, p.path("byte_bpe_50k.tiktoken"), p.PATTERN, group_docs=64, max_pieces=50).collect()
    ids = {r.doc_id: slow.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for i, rs in by_doc.items():
        at = 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[i])
    assert set(by_doc) == set(ids)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert k.pack(odd, path).groupBy("doc_id", "start").count().agg(F.sum("count")).first()[0] >= odd.count()
    assert k.pack(docs_of([]), path).count() == 0


def test_packing_first_fit_equals_a_plain_scan():
    from hydrolake.llm.packing import first_fit

    rnd = random.Random(1)
    lengths = sorted((rnd.randint(1, 1024) for _ in range(3000)), reverse=True)
    free, plain = [], []
    for n in lengths:
        i = next((i for i, room in enumerate(free) if room >= n), None)
        if i is None:
            free.append(1024)
            i = len(free) - 1
        plain.append((i, 1024 - free[i]))
        free[i] -= n
    assert list(zip(*first_fit(lengths, 1024))) == plain
    assert len(free) * 1024 < 1.02 * sum(lengths)


# language-model scores

def test_lm_scores_of_all_words_equal_brute_force(spark, docs_of):
    from hydrolake.llm import lm_scoring as lm

    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choices(["the", "of", "The", "river", "dam", "x", "y"] + [f"r{j}" for j in range(40)], k=rnd.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, " "), (102, "the dam"), (102, "the dam"), (None, "the dam of"), (103, "only here twice only here twice"),
             (104, "the dam " * 3000), *[(200 + i, "copied text of the river") for i in range(50)]]
    seqs = [["<s>"] + [w.lower() for w in (t or "").split()] for _, t in rows]
    own = [Counter(tuple(s[i:i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1)) if len(s) > 1 else Counter() for s in seqs]
    every, total = sum(own, Counter()), sum(len(s) - 1 for s in seqs)
    for order in (2, 3):
        got = {(r.doc_id, r.n_tokens, r.copies): r for r in lm.score(docs_of(rows, clashes=True), order=order).collect()}
        for (i, t), s, mine in zip(rows, seqs, own):
            want, back = 0.0, 0
            for at in range(1, len(s)):
                longest = min(order, at + 1)
                for n in range(longest, 0, -1):
                    g = tuple(s[at - n + 1:at + 1])
                    c = every[g] - mine[g]
                    if n == 1 or c > 0:
                        below = every[g[:-1]] - mine[g[:-1]] if n > 1 else total
                        want, back = want + math.log10(0.4 ** (longest - n) * max(c, 1) / below), back + (n == 1)
                        break
            r = got[i, len(s) - 1, rows.count((i, t))]
            assert r.n_backoff == back and ((r.log_score is None) if len(s) == 1 else math.isclose(r.log_score, want, rel_tol=1e-9))
        assert len(got) == len(set(rows))
    assert lm.score(docs_of([])).count() == 0


def test_lm_scores_of_many_slices_and_rows_that_wait_on_disk(spark, docs_of, monkeypatch):
    """Slices and buckets of any size give the same scores, and no row for each n-gram is kept or shuffled."""
    from hydrolake.llm import lm_scoring as lm

    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(["the", "of", "Dam"] + [f"r{j}" for j in range(300)], k=rnd.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, " "), *[(102, "the dam of")] * 3, (None, "the dam"), *[(200 + i, "a copied text of the river " * 3) for i in range(30)]]
    docs, kept, real = docs_of(rows), [], lm.cut

    def cut(df):
        done = real(df)
        kept.append(done.count())
        return done

    monkeypatch.setattr(lm, "cut", cut)
    fields = ("doc_id", "n_tokens", "n_backoff", "log_score", "mean_log_score", "copies")

    def scored():
        found = lm.score(docs).select(*fields[:3], *[F.round(c, 6).alias(c) for c in fields[3:5]], "copies")
        return sorted(map(tuple, found.collect()), key=str)

    whole = scored()
    assert sum(kept) < 10 and len(whole) == len(set(rows))
    monkeypatch.setattr(lm, "SLICE", 2000)
    monkeypatch.setattr(lm, "BUCKET", 1000)
    assert scored() == whole and sum(kept) > 20


def test_lm_order_of_keys_is_stable():
    import numpy as np

    from hydrolake.llm import lm_scoring as lm

    rng = np.random.default_rng(1)
    for keys in (rng.integers(0, 5, 0, np.uint64), rng.integers(0, 3, 500, np.uint64), rng.integers(0, 1 << 63, 5000, np.uint64),
                 (rng.integers(0, 50, 9000, np.uint64) << np.uint64(40)) | rng.integers(0, 3, 9000, np.uint64)):
        assert (lm.stable_order(keys) == np.argsort(keys, kind="stable")).all()
        gaps = np.diff(np.sort(keys), prepend=np.uint64(0))
        assert (lm.unpacked(lm.packed(gaps), len(gaps), np.uint64) == gaps).all()


def test_lm_keys_are_those_of_spark(spark):
    import numpy as np

    from hydrolake.llm import lm_scoring as lm

    pairs = [(random.Random(i).randint(-2**63, 2**63 - 1), i - 3) for i in range(50)]
    head, tail = (np.array(x, np.int64).view(np.uint64) for x in zip(*pairs))
    want = spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("k")).collect()
    assert {(r.a, r.b): r.k for r in want} == dict(zip(pairs, lm.joined_keys(head, tail).view(np.int64).tolist()))


def test_lm_scores_of_nonsense_are_the_lowest(spark, docs_of):
    """Rare words are no common word: random letters score below every document of the sample."""
    from hydrolake.llm import lm_scoring as lm

    rnd = random.Random(5)
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    junk = [(-1 - i, " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(200))) for i in range(5)]
    got = lm.score(docs.union(docs_of(junk).select("doc_id", "text"))).where("n_tokens >= 50").collect()
    real = [r.mean_log_score for r in got if r.doc_id >= 0]
    assert len(real) < len(got) and max(r.mean_log_score for r in got if r.doc_id < 0) < min(real)


# chat

CALLS = "conv_id long, call_id string, parent_id string, name string, arguments string"


def test_chat_links_orders_and_validates(spark):
    from hydrolake.llm import chat_format as c

    schema = {"add": {"required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "number", "minimum": 0}, "tags": {"type": "array", "items": {"type": "string"}}}}}
    chain = [(7, str(i), str(i - 1) if i else None, "add", '{"x": 1}') for i in range(50)]
    calls = chain + [(1, "a", None, "add", '{"tags": ["é"], "x": 2.0}'), (1, "b", "a", "add", '{"x": -1, "y": 2}'), (1, "c", "zz", "nope", "{}"),
                     (1, "d", "e", "add", '{"x": 1}'), (1, "e", "d", "add", '{"x": 1}'), (1, "f", "e", "add", '{"x": 1}'), (1, "s", "s", "add", '{"x": 1}'),
                     (1, "g", None, "add", "{bad"), (1, "h", None, "add", '{"x": NaN}'), (1, "dup", None, "add", '{"x": 1}'), (1, "dup", None, "add", '{"x": 1}'),
                     (1, "n", None, "add", None), (None, "a", None, "add", '{"x": 5}'), (1, None, None, "add", "{}")]
    results = [(7, "3", "ok"), (1, "a", "three"), (1, "lost", None), (1, "d", "x"), (None, "a", "null conversation"), (1, None, "no id")]
    got = {(r.conv_id, r.call_id): r for r in c.link(spark.createDataFrame(calls, CALLS).withColumn("key", F.lit(1)).repartition(4),
                                                     spark.createDataFrame(results, "conv_id long, call_id string, content string"), schema).collect()}
    assert all(got[7, str(i)].step == 2 * i for i in range(50)) and got[7, "3"].status == "linked" and got[7, "4"].status == "unanswered"
    status = {k[1]: r.status for k, r in got.items() if k[0] == 1}
    assert status == {"a": "linked", "b": "invalid", "c": "invalid", "d": "cyclic", "e": "cyclic", "f": "cyclic", "s": "cyclic", "g": "invalid",
                      "h": "invalid", "dup": "duplicate", "n": "invalid", "lost": "orphan"}
    assert got[1, "b"].problems == ["$.y: unknown", "$.x: minimum"] and got[1, "b"].step == 2 and got[1, "c"].step == 0
    assert got[1, "a"].json == '{"call":{"arguments":{"tags":["é"],"x":2},"name":"add"},"id":"a","result":{"content":"three"}}'
    assert got[None, "a"].status == "linked" and len(got) == 50 + 12 + 1
    empty = c.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], "conv_id long, call_id string, content string"), schema)
    assert empty.count() == 0


def test_chat_refuses_numbers_and_texts_that_are_none(spark):
    from hydrolake.llm import chat_format as c

    schema = {"add": {"properties": {"x": {"type": "integer"}}}}
    odd = {"big": '{"x": 1e400}', "long": '{"x": ' + "9" * 400 + "}", "longer": '{"x": ' + "9" * 9000 + "}", "half": '{"x": "\\ud800"}', "pair": '{"x": 1, "y": "\\ud83d\\ude00"}', "zero": '{"x": 1e3}'}
    calls = spark.createDataFrame([(1, k, None, "add", v) for k, v in odd.items()], CALLS)
    got = {r.call_id: r for r in c.link(calls, spark.createDataFrame([], "conv_id long, call_id string, content string"), schema).collect()}
    assert {k: r.problems for k, r in got.items()} == {k: [] if k in ("pair", "zero") else ["arguments: no JSON"] for k in odd}
    assert all(json.loads(got[k].json)["call"]["arguments"] == odd[k] for k in ("big", "long", "longer", "half"))


def test_chat_query_covers_the_conversations(spark):
    from hydrolake.llm.queries import QUERIES

    rows = spark.read.parquet(f"{SAMPLE}/conversations.parquet").collect()
    got = {(r.conv_id, int(r.call_id)): r for r in QUERIES["op9_chat_format"](spark, SAMPLE).collect()}
    role = {(r.conv_id, r.turn): r for r in rows}
    want = {k for k, r in role.items() if r.role == "user"} | {(r.conv_id, r.turn - 1) for r in rows if r.role == "assistant"}
    assert set(got) == want
    depth = {}
    for k in sorted(k for k, r in role.items() if r.role == "user"):
        up = next((p for p in ((k[0], k[1] - 1), (k[0], k[1] - 2)) if p in depth), None)
        depth[k] = depth[up] + 1 if up else 0
    for k, r in got.items():
        said, answer = role.get(k), role.get((k[0], k[1] + 1))
        if said and said.role == "user":
            assert r.step == 2 * depth[k]
            assert json.loads(r.json)["call"]["arguments"] == {"prompt": said.text, "turn": k[1]}
            assert (r.status == "linked") == (answer is not None and answer.role == "assistant")
        else:
            assert r.status == "orphan"


def test_chat_keeps_every_row_of_the_conversations(spark, tmp_path):
    from hydrolake.llm.queries import QUERIES

    odd = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "tool", "42"), (1, 3, "system", "é"), (1, 4, "user", "so?"),
           (2, 0, "system", "alone"), (3, 5, None, "no role"), (3, 6, "tool", None), (4, 0, "system", "before an answer"), (4, 2, "assistant", "answer"),
           (6, 1, "user", "first"), (6, 1, "user", "second"), (6, 1, "user", "second"), (6, 2, "assistant", "A1"), (6, 2, "assistant", "A2"), (6, 2, "assistant", None),
           (5, None, "user", "no turn"), (5, None, "user", "no turn"), (5, None, "system", None), (None, 0, "system", "no conversation"), (None, 1, "user", "q")]
    schema = "conv_id long, turn int, role string, text string"
    spark.createDataFrame(odd, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    for at in (str(tmp_path), SAMPLE):
        rows = spark.read.parquet(f"{at}/conversations.parquet").collect()
        found, status = Counter(), {}
        for r in QUERIES["op9_chat_format"](spark, at).collect():
            record = json.loads(r.json)
            if "call" in record:
                found[r.conv_id, record["call"]["arguments"]["turn"], "user", record["call"]["arguments"]["prompt"]] += 1
            if "result" in record:
                found[r.conv_id, int(r.call_id) + 1, "assistant", record["result"]["content"]] += 1
            for x in record.get("context", ()):
                found[r.conv_id, x["turn"], x["role"], x["text"]] += 1
            status[r.conv_id, r.call_id] = r.status, r.step
        assert found == Counter((r.conv_id, r.turn, r.role, r.text) for r in rows)
        if at != SAMPLE:
            assert status == {(1, "1"): ("linked", 0), (1, "4"): ("unanswered", 0), (2, "1"): ("context", -1), (3, "6"): ("context", -1),
                              (3, "7"): ("context", -1), (4, "1"): ("orphan", -1), (6, "1"): ("duplicate", status[6, "1"][1]), (5, None): ("context", -1), (None, "1"): ("unanswered", 0)}


# near copies

def test_simhash_equals_brute_force(spark, docs_of):
    from hydrolake.llm import simhash_dedup as s

    rows = near_copies() + [(3, "same id"), (3, "same id"), (None, "no id"), (None, None)]
    want = brute.simhash_components([(i, brute.simhash(t)) for i, t in rows])
    for bucket in (64, 1):       # by the index alone; by stars wherever two share a segment
        got = s.classes(docs_of(rows, clashes=True), max_bucket=bucket).collect()
        assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    kept = s.keep_one(docs_of(rows, clashes=True))
    components = {(r.component) for r in got}
    assert kept.count() == len(components) and kept.columns == docs_of(rows, clashes=True).columns
    assert s.classes(docs_of([])).count() == 0 and s.keep_one(docs_of([])).count() == 0


@pytest.mark.parametrize("distance,segments,bucket", [(1, 2, 1), (2, 2, 1), (2, 3, 1000), (3, 2, 1), (3, 2, 1000), (4, 3, 1000), (3, 4, 1000)])
def test_simhash_links_any_distance(spark, distance, segments, bucket):
    from hydrolake.llm import simhash_dedup as s
    from hydrolake.llm.components import components

    rnd = random.Random(distance)
    fps = set()
    for _ in range(12):
        f = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for b in rnd.sample(range(64), rnd.randint(0, distance + 1)):
                f ^= 1 << b
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = components(s.links(df, distance, segments, bucket), "a", "b").collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.component].add(r.node % 2**64)
    want = defaultdict(set)
    for f, root in brute.union([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance], fps).items():
        want[root].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_components_of_chains_and_stars(spark):
    from hydrolake.llm.components import components

    pairs = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3), (7000, 7001), (7001, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000), 7000: 7000, 7001: 7000}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# pipeline and queries

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    assert 4 <= len(c.STAGES) <= 5
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for name, stage in c.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SAMPLE).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.where("n_chars <> length(text)").count() == 0
        text = {r.doc_id: r.text for r in before.collect()}
        if name == "quality_rules":
            good = {i for i, t, _ in rows if not brute.quality(t)["base_failed"]}
            ids = {r.doc_id for r in docs.collect()}
            assert ids <= good and len(ids) == docs.count() and len(ids) > 0.8 * len(good)
        elif name == "simhash_dedup":
            components = brute.simhash_components([(i, brute.simhash(t)) for i, t in text.items()])
            assert sorted(r.doc_id for r in docs.collect()) == sorted({c for *_, c in components})
        elif name == "secret_scans":
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) == set(text)
            for i, t in text.items():
                assert not brute.assign_spans(after[i]) and (brute.assign_spans(t) or after[i] == t or "[novel]" in after[i])
        elif name == "mixing":
            words = lambda t: len(brute.WORD.findall(t or ""))
            sizes, taken = defaultdict(int), defaultdict(int)
            for r in before.collect():
                sizes[r.source] += words(r.text)
            for r in docs.collect():
                taken[r.source] += words(r.text)
            for s, aim in brute.targets(sizes).items():
                assert abs(taken[s] - aim) <= 3 * 64
        else:
            import public_tokenizers as p
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
            want = sum(len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.collect())
            assert docs.agg(F.sum("length")).first()[0] == want
            assert c.run(spark, SAMPLE).count() == docs.count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert c.run(spark, str(tmp_path)).count() == 0


def test_queries_read_whole_tables_and_keep_ids(spark):
    from hydrolake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    n, parts = docs.count(), docs.select(F.coalesce("source", F.lit(""))).distinct().count()
    for name, query in QUERIES.items():
        if name in ("op9_chat_format", "op4_packing"):
            continue
        out = query(spark, SAMPLE)
        if name == "op11_filter_audit":     # a row per part, order of the five filters and step
            assert out.count() == parts * 120 * 5
            continue
        assert out.count() == n and isinstance(out.schema["doc_id"].dataType, T.LongType), name


def test_fingerprint_classes_of_a_crowded_family(spark, docs_of, monkeypatch):
    """Hundreds of texts that are all much alike but linked to few: classes equal all-pairs comparison, blocks or not."""
    from hydrolake.llm import fingerprints as f

    rnd = random.Random(11)
    base, texts = [f"w{i}" for i in range(120)], []
    for i in range(150):
        w = list(base)
        for p in rnd.sample(range(120), rnd.choice([1, 2, 3, 4])):
            w[p] = f"x{rnd.randrange(4)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    sets = [brute.shingles(t) for t in texts]
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(150) for b in range(a + 1, 150)}
    root = brute.union([p for p, v in like.items() if v >= 0.8], range(150))
    assert 10 < len(set(root.values())) < 149
    for block in (256, 40):
        monkeypatch.setattr(f, "BLOCK", block)
        got = f.compare(docs_of(rows)).select("doc_id", "class_id").collect()
        assert {r.doc_id: r.class_id for r in got} == root


def test_fingerprint_classes_over_cells(spark, docs_of, monkeypatch):
    """A large family and very many copies, dealt out over cells and salts: classes equal all-pairs comparison."""
    from hydrolake.llm import fingerprints as f

    rnd = random.Random(5)
    base, texts = [f"w{i}" for i in range(150)], []
    for i in range(90):
        w = list(base if i % 3 else base[::-1])
        for p in rnd.sample(range(150), rnd.choice([1, 2, 3, 5])):
            w[p] = f"x{rnd.randrange(6)}"
        texts.append(" ".join(w))
    texts += [texts[7]] * 60 + ["", None, "one"]
    rows = list(enumerate(texts))
    sets = [brute.shingles(t or "") for t in texts]
    alike = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if (texts[a] or "") == (texts[b] or "")
             or (sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8)]
    root = brute.union(alike, range(len(texts)))
    for cell, guides in ((16, 3), (16, 0), (f.CELL, f.GUIDES)):
        monkeypatch.setattr(f, "CELL", cell)
        monkeypatch.setattr(f, "GUIDES", guides)
        got = f.compare(docs_of(rows)).select("doc_id", "class_id").collect()
        assert {r.doc_id: r.class_id for r in got} == root, (cell, guides)
