"""Jaccard join, conversation trie and whitening against brute force, and their corner cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarnlake.llm import conversation_trie, jaccard_join, queries, whitening

SF = "/root/testdata/sf0.001"


# 11: Jaccard join

def word_sets(texts, width=4):
    words = [(t or "").encode().lower().split() for t in texts]
    return [frozenset(b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset() for w in words]


def components_of(ids, sets, percent=85):
    """Smallest id reachable over links, all pairs compared."""
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    smallest = {}
    for i, d in enumerate(ids):
        smallest[top(i)] = min(d, smallest.get(top(i), d))
    return [smallest[top(i)] for i in range(len(ids))]


def near_copies(seed, count, words=60, changes=3):
    """Copies of one text with some words replaced, so that many pairs lie close to the limit."""
    random = np.random.default_rng(seed)
    base = [f"w{random.integers(500)}" for _ in range(words)]
    out = []
    for _ in range(count):
        own = list(base)
        for at in random.choice(words, int(random.integers(0, changes + 1)), replace=False):
            own[at] = f"x{random.integers(1 << 30)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("growth,percent,width", [(1, 85, 4), (64, 85, 4), (2, 80, 5)])
def test_join_of_near_copies_matches_brute_force(spark, growth, percent, width):
    texts = near_copies(1, 60) + near_copies(2, 40, 200, 9) + near_copies(3, 20, 8, 1) + ["a b", "a b", "a", "", " \n", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in jaccard_join.jaccard_components(rows, width, percent, growth).collect()}
    sets = word_sets(texts, width)
    want = components_of(range(len(texts)), sets, percent)
    assert [found[i].component_id for i in range(len(texts))] == want
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert len(set(want)) < len(texts) - 30


def test_join_verifies_only_pairs_of_different_components(spark):
    # A hundred copies that all link: a comparison with the first of a bucket is enough.
    texts = near_copies(4, 100, 300, 1)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard_join.profiles(rows, 30_000)
    members = jaccard_join.postings(found)
    assert members.count() > 0
    roots = jaccard_join.connect(found)
    assert len({r.component_id for r in roots.collect()}) == 1


def test_suffix_parity_bounds_the_difference(spark):
    texts = near_copies(5, 30, 80, 4)
    found = jaccard_join.profiles(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2500)
    shared = {bytes(r.key): list(r.shared) for r in found.collect()}
    rows = jaccard_join.postings(found).collect()
    by_h = defaultdict(list)
    for r in rows:
        by_h[r.h].append(r)
    for h, own in by_h.items():
        for a, b in zip(own, own[1:]):
            rest = [set(shared[bytes(r.key)][shared[bytes(r.key)].index(h) + 1:]) for r in (a, b)]
            bits = sum(((a[f"s{k}"] ^ b[f"s{k}"]) & (1 << 64) - 1).bit_count() for k in range(4))
            assert bits <= len(rest[0] ^ rest[1])


def test_shingle_hashes_tell_shingles_apart():
    random = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 50, n)).encode() for n in (0, 1, 2, 3, 4, 5, 300, 4000)]
    texts += [None, b" \t", b"\x0bA  b\r\nC d\x0c", "\u00e9\u00a0x \u2003y z w".encode(), b"x" * 70_000 + b" y"]
    seen = {}
    for text, alone in zip(texts, jaccard_join.Shingles(4)(texts)):
        words = (text or b"").lower().split()
        want = {b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
        assert len(alone) == len(want) and list(alone) == sorted(alone)
        assert list(jaccard_join.Shingles(4)([text])[0]) == list(alone)  # whatever stands beside it
        for w in want:
            seen.setdefault(w, set())
        for i in range(max(1, len(words) - 3)) if words else []:
            part = b" ".join(words[i:i + 4])
            seen[part].add(int(jaccard_join.Shingles(4)([part])[0][0]))
    assert all(len(hashes) == 1 for hashes in seen.values()) and len({min(h) for h in seen.values()}) == len(seen)


@pytest.mark.parametrize("flush,bucket", [(100, 50), (2_000_000, 2_000_000)])
def test_counts_of_texts_are_exact(spark, monkeypatch, flush, bucket):
    monkeypatch.setattr(jaccard_join, "FLUSH", flush)
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    texts = near_copies(7, 40, 80, 4) + ["a b", None]
    counts = Counter(int(h) & (1 << 48) - 1 for own in jaccard_join.Shingles(4)([(t or "").encode() for t in texts]) for h in own)
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.g: r.texts for r in jaccard_join.repeated(rows, 4, sum(counts.values())).collect()}
    assert found == {h: n for h, n in counts.items() if n > 1}
    words = jaccard_join.filter_words(spark.createDataFrame(list(found.items()), "g long, texts long"))
    g = np.array(list(found), np.uint64)
    assert (words[(g & np.uint64(len(words) - 1)).astype(np.int64)] & jaccard_join._bits(g) == jaccard_join._bits(g)).all()


def test_join_corner_cases(spark):
    long = " ".join(f"w{i % 9973}" for i in range(30_000))
    rows = [(1, "A b C d e", 0, 1), (1, "a B c d e", 0, 1), (2, "a b c d e", 0, 1), (None, "a b c d e", 0, 1), (None, None, 0, 1),
            (3, None, 0, 1), (4, "", 0, 1), (5, long, 0, 1), (6, long, 0, 1), (1, "other text of one id", 0, 1), (7, "É b c d e", 0, 1),
            (8, "é b c d e", 0, 1), (2, "a b c d e", 0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, part int")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()), key=str)
    assert found == sorted([
        (1, 2, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (None, 2, 1), (None, 0, None), (3, 0, 3), (4, 0, 4), (5, 9973, 5), (6, 9973, 5),
        (1, 2, 1), (7, 2, 7), (8, 2, 8)], key=str)
    assert jaccard_join.jaccard_components(df.limit(0)).collect() == []


# 12: conversation trie

def plain_nodes(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append((c, len(path) == d))
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    return sorted(((
        min(m)[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(m), kids[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest()) for p, m in nodes.items()), key=key_of)


def key_of(row):
    return tuple((v is None, v) for v in row)


def found_nodes(df, shards=None):
    found = conversation_trie.trie_nodes(conversation_trie.rebuilt(df), shards).collect()
    return sorted((tuple(r) for r in found), key=key_of)


@pytest.fixture(scope="module")
def talks():
    """Hot first turns, a conversation that a third of all are, chains, NULLs, repeated rows."""
    random = np.random.default_rng(3)
    rows = []
    for c in range(0, 900, 3):
        same = random.random() < 0.35
        for t in range(7 if same else int(random.integers(1, 9))):
            text = f"t{t}" if same else f"t{int(random.integers(2))}é\U0001f600"
            rows.append((c, t, "user" if t % 2 == 0 else None, text))
    rows += [(1000, t, "user", f"deep {t}") for t in range(700)] + [(1100, t, "user", f"deep {t}") for t in range(650)]
    rows += [(5, None, None, None), (5, 2, "user", ""), (5, 2, "user", ""), (None, 1, "user", "lost"), (1201, None, "a", "b"), (1201, None, "a", "b")]
    return rows


@pytest.mark.parametrize("shards", [None, 1, 2, 7, 150])
def test_trie_matches_brute_force(spark, talks, shards):
    df = spark.createDataFrame([(*r, 1) for r in talks], "conv_id long, turn long, role string, text string, path int")
    assert found_nodes(df, shards) == plain_nodes(talks)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.trie_nodes(conversation_trie.rebuilt(df)).collect() == []


def test_trie_hashes_chunks_of_a_hot_node(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 20)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 30_000, 100) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found_nodes(df, 9) == plain_nodes(rows)


# 13: whitening

@pytest.mark.parametrize("size", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "rank", "steep", "close"])
def test_slicing_finds_eigenpairs(size, kind):
    random = np.random.default_rng(size)
    basis = np.linalg.qr(random.standard_normal((size, size)))[0]
    values = np.sort({
        "random": random.random(size), "equal": np.repeat([3.0, 1.0], size)[:size], "rank": np.r_[np.full(size // 2, 5.0), np.zeros(size - size // 2)],
        "steep": np.logspace(0, -9, size), "close": 1 + np.arange(size) * 1e-13}[kind])[::-1]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    exact = np.linalg.eigvalsh(matrix)[::-1]
    for shift in (-1.0, 0.31, 0.5, 2.0):
        assert whitening.inertia(matrix, shift) == (exact > shift).sum()
    found, vectors = whitening.Slicer(matrix).leading(16)
    assert len(found) == min(16, (values > 1e-10).sum())
    assert np.abs(found - exact[:len(found)]).max(initial=0) < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-12


def plain_whitening(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    own = np.unique(x, axis=0)
    n, total = len(own), own.sum(axis=0)
    centred = own - total / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:16], basis[:, ::-1][:, :16]
    deviation = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, total)) for row in x]
    return n, deviation, (x - total / n) @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_matches_plain(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    vectors = vectors.unionByName(vectors.where("vec_id < 40"))
    rows = sorted(vectors.collect(), key=lambda r: r.vec_id)
    n, deviation, whitened, explained = plain_whitening([r.embedding for r in rows])
    found = sorted(whitening.whiten(vectors).collect(), key=lambda r: r.vec_id)
    assert len(found) == 16 * len(rows) and {r.n for r in found} == {n}
    values = defaultdict(dict)
    for r in found:
        values[r.vec_id][r.component] = r
    ids = [r.vec_id for r in rows]
    own = np.array([[values[i][k].whitened for k in range(1, 17)] for i in ids])
    assert np.abs(own - whitened * np.sign((own * whitened).sum(axis=0))).max() < 1e-9
    assert [values[i][1].deviation for i in ids] == deviation
    assert np.allclose([values[0][k].explained for k in range(1, 17)], explained, rtol=1e-10)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-10


def test_whitening_corner_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0], 0), (2, [1.0, 5.0], 0), (None, [4.0, -7.0], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (5, [None, 1.0], 0), (6, None, 0),
            (7, [], 0), (8, [1.0], 0), (1, [0.0, 1.0], 0), (9, [1e300, -1e300], 0)]
    ddl = "vec_id long, embedding array<double>, x int"
    plain = spark.createDataFrame(rows[:-1], ddl)
    found = whitening.whiten(plain).collect()
    assert sorted(str(r.vec_id) for r in found) == ["1"] * 4 + ["2"] * 2 + ["None"] * 2 and {r.n for r in found} == {3}
    large = whitening.whiten(spark.createDataFrame(rows, ddl)).collect()
    assert {r.vec_id for r in large} == {1, 2, None, 9} and {r.deviation for r in large} == {None}
    assert whitening.whiten(plain.where("vec_id = 1")).collect() == []
    assert whitening.whiten(plain.limit(0)).collect() == []
    # A dimension that never changes, and one that repeats another, leave fewer components.
    flat = spark.createDataFrame([(i, [float(i % 7), 3.0, float(i % 7), float(i % 5)], 0) for i in range(35)], ddl)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1, 2}


def test_registered_queries_have_the_columns_asked_for(spark):
    assert queries.op11_jaccard_join(spark, SF).columns == ["doc_id", "n_shingles", "component_id"]
    assert queries.op13_whitening(spark, SF).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
