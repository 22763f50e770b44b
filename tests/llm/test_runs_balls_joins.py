"""Periodic runs, ball k-means and the PartEnum join against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessella.llm import balls, lattice, minhash, partenum, periodic, pieces, queries, token_counts

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """Every stretch of period p, its smallest period by trial."""
    found, n = set(), len(w)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            s, e = i, j + p
            if e - s >= max(6, 4 * p) and not any(all(w[k] == w[k + q] for k in range(s, e - q)) for q in range(1, p)):
                found.add((s, e - s, p))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("small", [True, False])
def test_runs_equal_brute_force(small, monkeypatch):
    rng = random.Random(5)
    if not small:
        monkeypatch.setattr(periodic, "SMALL", 1)
        monkeypatch.setattr(periodic, "QUERIES", 7)
        periodic._grid_table.cache_clear()
    for _ in range(500):
        kind, n = rng.randrange(4), rng.randrange(0, 60)
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(n)]
        if kind == 1:
            p = rng.randrange(1, 8)
            w = w[:5] + (w[:p] * 12)[: 4 * p + rng.randrange(4)] + w[5:9]
        if kind == 2:
            w = [9] * rng.randrange(8) + [1, 2] * rng.randrange(9) + [2] * rng.randrange(9)
        assert periodic.runs(np.array(w, np.int64)) == plain_runs(w), w
    periodic._grid_table.cache_clear()


def test_extensions():
    w = np.random.default_rng(3).integers(0, 2, 200)
    lce = periodic.Extensions(w)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(200), np.arange(200)))
    i, j = i[i != j], j[i != j]
    want = [next((k for k in range(200) if max(a, b) + k >= 200 or w[a + k] != w[b + k]), 0) for a, b in zip(i.tolist(), j.tolist())]
    assert lce(i, j).tolist() == want


def test_periodic_runs_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 3000)
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    edited = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = periodic.edited([w.encode() for w in __import__("re").findall("[^\x20\x09-\x0d]+", text or "")], doc_id)
        found = plain_runs(words)
        row = got[doc_id]
        edited += bool(found)
        assert row["n_runs"] == len(found) and row["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest()
        gone = {k for s, n, p in found for k in range(s + p, s + n)}
        assert row["collapsed_sha256"] == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()
        if found:
            s, n, p = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (s, n, p, 1000 * n // p)
    assert edited > 5


def test_edited_words():
    words = [b"%d" % k for k in range(40)]
    for doc_id in range(200):
        got = periodic.edited(words, doc_id)
        assert len(got) == 40 and (got == words) == (__import__("zlib").crc32(str(doc_id).encode()) % 10 != 0)
    assert periodic.edited(words, None) is words and periodic.edited([], 3) == []


def test_long_texts_of_one_word_or_of_none_repeated():
    began = time.time()
    assert periodic.runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert periodic.runs(np.arange(1_000_000)) == []
    assert periodic.runs(np.tile(np.arange(50_000), 5)) == [(0, 250_000, 50_000)]
    assert time.time() - began < 60


# --- ball k-means


def plain_kmeans(rows, k, rounds):
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(r[1]) for r in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        near = [nearest(x)[1] for _, x in rows]
        for c in range(len(cents)):
            own = [x for (_, x), n in zip(rows, near) if n == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in rows], cents


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_ball_kmeans_equals_plain(spark, spread):
    rng = random.Random(11)
    centres = [[rng.uniform(-8, 8) for _ in range(4)] for _ in range(6)]
    data = [(i, [c + rng.gauss(0, spread) for c in centres[i % 6]]) for i in range(300)]
    data += [(1000 + i, data[i][1]) for i in range(20)]  # copies: ties everywhere
    rows = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in data]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    got = balls.ball_kmeans(df, k=7, rounds=3, dimensions=4).collect()
    want, cents = plain_kmeans(rows, 7, 3)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(want)
    inertia = {}
    for _, c, d in want:
        inertia[c] = inertia.get(c, 0) + d
    for r in got:
        assert r["cluster_inertia"] == inertia[r["cluster"]] and r["inertia"] == sum(inertia.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()


def test_stable_core_is_not_compared():
    near = balls.Balls([[0, 0], [100, 0], [1000, 0]], [10, 60, 5])
    assert [n.tolist() for n, _ in near.neighbours] == [[], [0], []]
    full = balls.Balls([[0, 0], [100, 0], [1000, 0]])
    cluster, distance = full.assign(np.array([[50, 0], [51, 0], [900, 0]]), np.array([1, 0, 0]))
    assert cluster.tolist() == [0, 1, 2] and distance.tolist() == [2500, 2401, 10_000]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (1, [0.5, 1.0]), (None, [2.0, -2.0]), (8, [-0.01, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("x", "cluster", "distance", "e", "n", "far", "sums")})
    got = balls.ball_kmeans(df, k=16, dimensions=2)
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in got.collect()) == [(0, 0), (1, 0), (1, 0), (8, 0)]
    empty = balls.ball_kmeans(df.limit(0), k=16, dimensions=2)
    assert empty.schema == got.schema and empty.count() == 0
    with pytest.raises(Exception, match="too large"):
        balls.ball_kmeans(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dimensions=2).collect()


# --- PartEnum


def jaccard(a, b, percent):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("percent", [85, 80, 60, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(7)
    linked = 0
    for size in [*range(1, 40), 60, 100, 240, 700, 3000]:
        for _ in range(20 if size < 200 else 4):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            lost, new = rng.integers(0, 1 + size * (100 - percent) // 90, 2)
            b = np.r_[rng.permutation(a)[: size - min(lost, size - 1)], rng.integers(0, 1 << 63, new, dtype=np.uint64)]
            a, b = np.unique(a), np.unique(b)
            if jaccard(a, b, percent) and (len(a) != len(b) or (a != b).any()):
                linked += 1
                assert len(np.intersect1d(partenum.set_signatures(a, percent)[1], partenum.set_signatures(b, percent)[1])), size
    assert linked > 100


@pytest.mark.parametrize("attempts", [1, 2])
def test_hollow_sets_share_a_signature(monkeypatch, attempts):
    monkeypatch.setattr(partenum, "ATTEMPTS", attempts)
    monkeypatch.setattr(partenum, "scheme", lambda band, percent: (45, 3, 10))  # more parts than shingles: most groups are hollow
    rng = np.random.default_rng(9)
    for size in (8, 20, 45):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        assert len(np.intersect1d(partenum.set_signatures(a, 85)[1], partenum.set_signatures(a[1:], 85)[1]))


def test_fine_sketches_bound_differences():
    rng = np.random.default_rng(4)
    for n, m in ((50, 60), (900, 1100), (1000, 1150), (5000, 5200), (9000, 9000)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[: n - n // 10], rng.integers(0, 1 << 63, m - n + n // 10, dtype=np.uint64)])
        differ = len(np.setxor1d(a, b))
        assert differ // 3 < partenum.least_differences(partenum.fine_sketch(a), partenum.fine_sketch(b)) <= differ
    assert partenum.least_differences(partenum.fine_sketch(a), partenum.fine_sketch(a)) == 0


def plain_components(sets, percent):
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(sets[a]) and len(sets[b]) and jaccard(sets[a], sets[b], percent):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def made_texts(n, seed):
    """Families of copies with edits, from near to far, and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = {}
    for i in range(n):
        kind = rng.randrange(5)
        if kind == 0 or not texts:
            text = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 6, 9, 30, 120]))]
        else:
            text = texts[rng.choice(list(texts))].split() or ["w"]
            for _ in range(rng.randrange(0, 2 + len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if kind == 2:
                text = text[rng.randrange(2) :]
        texts[i] = " ".join(text)
    return texts


@pytest.mark.parametrize("first,block", [(8, 2048), (1, 4)])
def test_join_equals_brute_force(spark, monkeypatch, first, block):
    monkeypatch.setattr(partenum, "FIRST", first)
    monkeypatch.setattr(partenum, "MORE", 2)
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = made_texts(260, first)
    want = plain_components({i: minhash.shingle_hashes(t, 4) for i, t in texts.items()}, 85)
    got = partenum.similar_sets(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert len(set(want.values())) < 200


def test_odd_documents(spark):
    long = " ".join(f"x{k}" for k in range(30_000))
    rows = [(1, "a b c d e"), (2, "A B c D e"), (2, long), (3, long + " y"), (4, ""), (5, None), (6, " \n"), (None, "a b c d e"), (None, None), (7, "a"), (8, "a"), (8, "a"), (9, "b a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "comp", "digest", "sign", "signatures", "sketch", "n_shingles", "a", "b", "hit", "key", "n")})
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in partenum.similar_sets(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (2, 2, 1), (2, 29_997, 1), (3, 29_998, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (0, 2, None), (0, 0, None), (7, 1, 7), (8, 1, 7), (8, 1, 7), (9, 1, 9)], key=str)
    empty = partenum.similar_sets(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id"]


def test_odd_documents_have_runs(spark):
    rows = [(1, "a a a a a a"), (None, "b b b b b b"), (3, None), (4, ""), (4, ""), (5, "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("start", "length", "period", "n_runs")})
    got = periodic.periodic_runs(df).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(((r["doc_id"] or 0, r["n_runs"], r["length"], r["period"]) for r in got), key=str) == [(0, 1, 6, 1), (1, 1, 6, 1), (3, 0, None, None), (4, 0, None, None), (4, 0, None, None), (5, 1, 50_000, 1)]
    assert all(r["runs_sha256"] == none and r["collapsed_sha256"] == none for r in got if r["doc_id"] in (3, 4))
    assert periodic.periodic_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_ball_kmeans", "op13_partenum_join"])
def test_rows_match_their_table(spark, name):
    table = "embeddings" if "op12" in name else "documents"
    assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


# --- long words


def long_words(n):
    rng = random.Random(n)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    yield "".join(rng.choice(alphabet) for _ in range(n))
    yield "".join(rng.choice("aeiourstln") for _ in range(n))
    yield ("the" * n)[:n]
    yield "\t".join(str(rng.randrange(10_000)) for _ in range(n // 5))
    yield "a" * n


def test_long_words_encode_as_the_library_has_them():
    model = pieces.read_model(pieces.model_path())
    table, tool = pieces.piece_table(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for n in (65, 300, 3000):
        for word in long_words(n):
            assert lattice.fold_word(pieces.SPACE + word, table) == tool.encode(word)
            assert lattice._merged_by_heap(word[:60], table) == lattice.merged_word(word[:60], table)


def test_a_word_of_a_million_characters_takes_seconds():
    table = pieces.piece_table(pieces.read_model(pieces.model_path()))
    began = time.time()
    word = next(long_words(1_000_000))
    assert "".join(lattice.merged_word(word, table)) == word and time.time() - began < 60


def test_long_segments_are_not_remembered():
    model = pieces.read_model(pieces.model_path())
    counter, tool = token_counts.TokenCounter(model, token_counts.whole_tokens(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    before = len(counter.words) + len(counter.bare)
    for seed in range(20):
        text = " ".join(["x", *long_words(5000 + seed)])
        assert counter(text) == len(tool.encode(text))
    assert len(counter.words) + len(counter.bare) - before < 10_000 and max(map(len, counter.words)) <= 256


def test_word_hashes_need_no_digest_a_word(monkeypatch):
    """Equal words have equal hashes at any place, in any block; sets count the shingles of a plain split; only very long words are digested one by one."""
    rng, made, seen = random.Random(5), [], {}
    digest = minhash.hashlib.blake2b
    monkeypatch.setattr(minhash.hashlib, "blake2b", lambda *a, **k: made.append(a) or digest(*a, **k))
    for n in [*range(60), 30_000]:
        text = "".join(rng.choice("aAbB\x00\u00e9\u00c9\u20ac \t\n\x0b\x0c\x1c\x85\u3000") for _ in range(n * 3))
        words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[^\x20\x09-\x0D]+", text.encode()) if len(w) <= 64]
        text = b" ".join(words).decode()
        assert len(minhash.shingle_hashes(text, 4)) == len({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else ())
        for word, h in zip(words, minhash.word_hashes(text.encode()).tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) > 1000 and not made
    long = ["x" * 64, "x" * 65, "x" * 64 + "y", "x" * 65, "x" * 1_000_000]
    assert len(set(minhash.word_hashes(" ".join(long).encode()).tolist())) == 4 and len(made) == 4
