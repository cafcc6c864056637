"""Filter audit, token files and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from . import brute
from .conftest import ODD_TEXTS

SAMPLE = "/root/testdata/sf0.001"


# filter audit

def audit_by_hand(rows, labels):
    """{(part, order, step): counts} straight from the definitions; rows of (doc_id, text, source)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, t, s in rows:
        t = t or ""
        w = brute.WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)}
        docs.append((s or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        orders = ["".join(p) for p in permutations("ABCDE")]
        removed_at = {(o, f): [d for d in own if f in d[1] and not d[1] & set(o[:o.index(f)])] for o in orders for f in "ABCDE"}
        shapley = {f: sum(len(removed_at[o, f]) for o in orders) for f in "ABCDE"}
        for o in orders:
            for step, f in enumerate(o, 1):
                gone = removed_at[o, f]
                out[part, o, step] = (sum(not d[1] & set(o[:step]) for d in own), len(gone), sum(f in d[1] for d in own) - len(gone),
                                      sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), shapley[f])
    return out


def audited(df, labels, **how):
    from hydrolake.llm import filter_audit as a

    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in a.audit(df, labels, **how).collect()}


def audit_rows(n=150, seed=8):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choices("abcé\x1f", k=rnd.choice([1, 3, 6]))) for _ in range(rnd.choice([0, 5, 199, 200, 201, 400]))]
        words = [rnd.choice(["X", "#", "Ab", w]) if rnd.random() < 0.01 else w for w in words]
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(words), rnd.choice(["a", "b", None, "", "hot", "hot", "hot"])))
    rows += [(n + i, rnd.choice(rows)[1], rnd.choice(["hot", "a"])) for i in range(60)]
    half = " ".join(str(i) for i in range(100))     # just 200 words, just half of them different, just 2 % capitals
    rows += [(900, f"{half} {half}", "edge"), (901, f"{half} {half} 1", "edge"), (902, "A" * 2 + " " * 98, "edge"), (903, "A" * 3 + " " * 97, "edge")]
    rnd.shuffle(rows)
    return rows


def test_audit_equals_brute_force(spark, docs_of):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 5 == 0)) for i, _, _ in rows if i % 3] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None)]
    df = docs_of([(i, t, None, s) for i, t, s in rows], clashes=True).withColumns({c: F.lit(1) for c in ("fails", "text_hash", "words", "shard")})
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audit_by_hand(rows, labels)
    assert audited(df, table) == want
    assert audited(df.repartition(2), table, shard_bytes=2000) == want


def test_audit_odd_rows(spark, docs_of, odd):
    labels = spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert audited(odd, labels) == audit_by_hand(rows, [(0, 1, 1)])
    assert audited(docs_of([]), labels) == {}
    assert audited(odd, labels.where("false")) == audit_by_hand(rows, [])


def test_matrix_holds_the_words(spark, docs_of):
    from hydrolake.llm import filter_audit as a

    rows = audit_rows(40) + [(999, None, None)]
    csr, dictionary = a.matrix(docs_of([(i, t, None, s) for i, t, s in rows]), shard_bytes=3000, bucket_words=100)
    known = {r.base + k: w for r in dictionary.collect() for k, w in enumerate(bytes(r.words).split())}
    assert sorted(known) == list(range(len(known))) and len(set(known.values())) == len(known) and dictionary.count() > 8
    got = []
    for s in csr.collect():
        indices, data = np.frombuffer(s.indices, "<i8"), np.frombuffer(s.data, "<i4")
        for i, lo, hi in zip(s.doc_id, s.ends, s.ends[1:]):
            got.append((i, {known[w].decode(): n for w, n in zip(indices[lo:hi].tolist(), data[lo:hi].tolist())}))
    want = [(i, dict(Counter(brute.WORD.findall(t or "")))) for i, t, _ in rows]
    assert sorted(got, key=lambda x: (x[0], str(sorted(x[1])))) == sorted(want, key=lambda x: (x[0], str(sorted(x[1]))))
    assert csr.count() > 3


def test_packed_rows_round_trip():
    from hydrolake.llm import filter_audit as a

    rnd = np.random.default_rng(1)
    sizes = [0, 5, 0, 0, 90, 1, 0]
    ends = np.cumsum([0, *sizes])
    indices = np.concatenate([rnd.choice(1 << 31, n, replace=False) for n in sizes]).astype(np.int64)
    data = rnd.integers(1, 1 << 30, len(indices)).astype(np.int32)
    got = a.unpacked_rows(*a.packed_rows(indices, data, ends), ends)
    for lo, hi in zip(ends, ends[1:]):
        assert dict(zip(got[0][lo:hi].tolist(), got[1][lo:hi].tolist())) == dict(zip(indices[lo:hi].tolist(), data[lo:hi].tolist()))
    none = a.unpacked_rows(*a.packed_rows(indices[:0], data[:0], np.array([0, 0])), np.array([0, 0]))
    assert len(none[0]) == len(none[1]) == 0


# token files

@pytest.fixture(scope="module")
def public():
    return pytest.importorskip("public_tokenizers")


def encode(public):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def write(public, df, folder, **how):
    from hydrolake.llm import token_files as f

    return f.write(df, folder, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, **how)


def test_token_files_round_trip(spark, docs_of, public, tmp_path):
    from hydrolake.llm import token_files as f

    ids_of = encode(public)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(5000, "same")] * 40
    df = docs_of(rows, clashes=True)
    folder = f"file:{tmp_path}/files"
    listed = write(public, df, folder, files=7).orderBy("place").collect()
    rows.sort(key=lambda r: r[0])
    want, at = [], 0
    for i, t in rows:
        ids = ids_of(t)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in f.read(spark, folder, with_ids=True).collect()), key=lambda r: r[1])
    assert got == want
    # plain numpy over the files in the manifest's order gives the same stream
    assert len(listed) > 3 and {r.id_bits for r in listed} == {16}
    flat = np.concatenate([np.fromfile(tmp_path / "files" / f"{r.file}.bin", "<u2") for r in listed])
    assert flat.tolist() == [x for w in want for x in w[4]]
    for r in listed:
        held = f.TokenFile(folder, r.file, r.id_bits)
        assert len(held) == r.n_docs and held.offsets[-1] == r.n_ids and held.ids(0).tolist() == want[r.doc_base][4]
        assert held.offsets.dtype == np.dtype("<u8") and want[r.doc_base][1] == r.id_base


def test_token_files_of_odd_rows(spark, docs_of, odd, public, tmp_path):
    from hydrolake.llm import token_files as f

    ids_of = encode(public)
    write(public, odd, f"{tmp_path}/odd")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in f.read(spark, f"{tmp_path}/odd").collect())
    order = [r[1] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i)) and len(got) == odd.count()
    assert sum(n for *_, n in got) == sum(len(ids_of(r.text)) for r in odd.collect())
    assert all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:])) and got[0][0] == 0
    write(public, docs_of([]), f"{tmp_path}/none")
    assert f.read(spark, f"{tmp_path}/none").count() == 0
    names = spark.createDataFrame([("b", "two"), ("a", "one"), (None, "none")], "doc_id string, text string")
    write(public, names, f"{tmp_path}/names")
    assert [r.doc_id for r in f.read(spark, f"{tmp_path}/names").orderBy("start").collect()] == [None, "a", "b"]


def test_token_files_ignore_lost_attempts(spark, docs_of, public, tmp_path):
    """A task that fails after writing leaves files that the manifest doesn't name."""
    from hydrolake.llm import token_files as f

    df = docs_of([(i, f"text {i}") for i in range(20)])
    write(public, df, f"{tmp_path}/t", files=3)
    (tmp_path / "t" / "part-000001-of-a-lost-attempt.bin").write_bytes(b"\1\0" * 50)
    assert f.read(spark, f"{tmp_path}/t").count() == 20


def test_id_types():
    from hydrolake.llm import token_files as f

    assert f.id_type(50_257).itemsize == 2 and f.id_type(1 << 16).itemsize == 2 and f.id_type((1 << 16) + 1).itemsize == 4


# Merkle manifest

def hashed(joined):
    return hashlib.sha256(joined.encode()).hexdigest()


def leaf_by_hand(doc_id, text, lang, source, n_chars):
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return hashed(out)


def tree_by_hand(leaves):
    """The root, and for each leaf the siblings' runs: (before, after) level by level."""
    paths, level, own = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        nodes, members = [], []
        for at in range(0, len(level), 16):
            run = level[at:at + 16]
            for j in range(len(run)):
                for i in own[at + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            nodes.append(hashed("".join(run)))
            members.append([i for m in own[at:at + 16] for i in m])
        level, own = nodes, members
    return level[0], paths


def manifest_by_hand(rows):
    """Sorted result rows of (doc_id, text, lang, source, n_chars) rows."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = [], []
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(*r)))
        trees.append((own, *tree_by_hand([leaf_by_hand(*r) for r in own])))
    root, above = tree_by_hand([t[1] for t in trees])
    for (own, subroot, paths), upper in zip(trees, above):
        for r, path in zip(own, paths):
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                changed[1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            folded = leaf_by_hand(*changed)
            for before, after in path + upper:
                folded = hashed("".join(before) + folded + "".join(after))
            proof = hashed("".join("".join(b) + "".join(a) for b, a in path + upper))
            out.append((r[0], leaf_by_hand(*r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def manifested(df):
    from hydrolake.llm import merkle as m

    return sorted((tuple(r) for r in m.verify(df, m.tampered_text()).collect()), key=str)


def plain(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_manifest_equals_brute_force(spark, docs_of):
    rnd = random.Random(6)
    sizes = {"one": 1, "two": 2, "run": 16, "more": 17, "é": 33, None: 5, "": 3, "\U0001F600": 256, "￮": 257, "hot": 700}
    rows = [(s, f"{rnd.choice(['Ab', 'ab', 'É'])} {rnd.random()}") for s, n in sizes.items() for _ in range(n)]
    rnd.shuffle(rows)
    df = docs_of([(i, t, rnd.choice(["en", None]), s) for i, (s, t) in enumerate(rows)], clashes=True)
    df = df.withColumns({c: F.lit(f"x_{c}") for c in ("_tree", "_pos", "_n", "_hash", "leaf", "root", "_read", "_of", "_block")})
    want = manifest_by_hand(plain(df))
    assert manifested(df) == want
    assert 0 < sum(not r[-1] for r in want) < len(want) / 4


def test_manifest_odd_rows(spark, docs_of, odd):
    assert manifested(odd) == manifest_by_hand(plain(odd))
    assert manifested(docs_of([])) == []
    one = docs_of([(5, "Only", None, None)])
    assert manifested(one) == manifest_by_hand(plain(one)) and manifested(one)[0][4] == hashed("")
    many = docs_of([(i, f"T{i}", None, f"s{i % 300}") for i in range(300)])       # every source a lone leaf, two levels of sources
    assert manifested(many) == manifest_by_hand(plain(many))


def test_manifest_over_several_rounds(spark, docs_of, monkeypatch):
    """Blocks of 16 leaves instead of 4,096: block roots are appended for three rounds."""
    from hydrolake.llm import merkle as m

    df = docs_of([(i, f"T{i}", None, "a" if i % 7 else "b") for i in range(1500)])
    want = manifest_by_hand(plain(df))
    assert manifested(df) == want
    # the workers have their own copy of the module: the smaller blocks are passed along
    monkeypatch.setattr(m, "BLOCK_LEVELS", 1)
    nodes = spark.createDataFrame([("a", i, 1500, hashlib.sha256(b"%d" % i).digest()) for i in range(1500)], m._NODE)
    layers = m.rounds(nodes)
    assert [x.count() for x in layers] == [1500, 94, 6, 1]
    assert layers[-1].first()._hash.hex() == tree_by_hand([hashlib.sha256(b"%d" % i).hexdigest() for i in range(1500)])[0]
    assert manifested(df) == want


def test_appended_witnesses_grow_with_later_siblings():
    from hydrolake.llm import merkle as m

    values = [hashed(str(i)).encode() for i in range(300)]
    block, nodes = m.Block(3), []
    for k, v in enumerate(values):
        nodes.append(block.append(v))
        run = k // 16 * 16
        assert bytes(nodes[k].witness) == b"".join(values[run:k])                        # what came before it
        assert bytes(nodes[run].witness) == b"".join(values[run + 1:k + 1])              # what has come since
    root = block.finish()
    want, paths = tree_by_hand([v.decode() for v in values])
    assert root.decode() == want
    for n, path in zip(nodes, paths):
        assert n.path().decode() == "".join("".join(b) + "".join(a) for b, a in path)
    for k in (0, 17, 299):
        assert m.fold(values[k], nodes[k].path(), [(k, 300)]) == root
        assert m.fold(b"0" * 64, nodes[k].path(), [(k, 300)]) != root
