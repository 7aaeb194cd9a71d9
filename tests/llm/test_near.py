"""Similarity, repeats, neighbours and fingerprints against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty, texts, words
from tideline.llm import fingerprints, jaccard, neighbours, repeats


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute_components(rows):
    comp = list(range(len(rows)))
    sets = [shingles(t) for _, t in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and comp[i] != comp[j]:
            old = comp[j]
            comp = [comp[i] if c == old else c for c in comp]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if comp[m] == comp[k] and rows[m][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids) if ids and sets[k] else doc_id))
    return sorted(out, key=repr)


def small_texts(seed):
    rng = random.Random(seed)
    base = ["a b c d e f g h i j k l m n o p".split()[: rng.randint(1, 16)] for _ in range(8)]
    out = []
    for b in base * 6:
        c = list(b)
        if rng.random() < 0.7:
            c[rng.choice([0, -1])] = rng.choice("xyz")
        if rng.random() < 0.3:
            c.append(rng.choice("qrs"))
        out.append(" ".join(c))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_small_sets(spark, seed):
    rows = list(enumerate(small_texts(seed)))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_jaccard_mixed(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.link_documents(docs).collect()), key=repr) == brute_components(rows)
    assert jaccard.link_documents(empty(spark)).collect() == []


def test_jaccard_group_of_near_copies(spark):
    rng = random.Random(3)
    base = words(rng, 80).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(80)] = f"edit{rng.random()}"
        rows.append((i, " ".join(w)))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        all_ = rng.integers(0, 2**64, 300, np.uint64)
        a, b = np.unique(all_[: rng.integers(1, 250)]), np.unique(all_[rng.integers(0, 200) :])
        assert jaccard.distance(jaccard.sketch(a), jaccard.sketch(b)) <= len(np.setxor1d(a, b))


def test_need_and_boundary():
    for s in range(1, 60):
        for t in jaccard.partners(s):
            n = jaccard.need(s, t)
            assert 100 * n >= 80 * (s + t - n) and 100 * (n - 1) < 80 * (s + t - n + 1)
    assert jaccard.boundary() >= 5


def brute_repeats(rows):
    first = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        if doc_id is not None:
            for s in range(len(b) - 49):
                w = b[s : s + 50]
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        if doc_id is not None:
            for s in range(len(b) - 49):
                if first[b[s : s + 50]] < doc_id:
                    gone[s : s + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc_id, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)
    assert repeats.remove_repeats(empty(spark)).collect() == []


@pytest.mark.parametrize("buckets", [1, 7])
def test_repeats_at_the_edges(spark, monkeypatch, buckets):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000 // buckets)
    monkeypatch.setattr(repeats, "SEND_BYTES", 3_000)
    rng = random.Random(buckets)
    source = "".join(rng.choice("abcdef ") for _ in range(900))
    rows = [(0, source)]
    for i in range(1, 60):
        a = rng.randrange(800)
        n = rng.choice([48, 49, 50, 51, 52, 60, 99, 100])
        rows.append((i, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 30))) + source[a : a + n] + "é" + source[:50] * rng.randint(0, 2)))
    rows += [(60, "aaaa" * 40), (61, "aaaa" * 30), (62, "a" * 49), (61, "aaaa" * 35)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32)
    vectors[100:700] = vectors[100]  # one vector with two fifths of the rows
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [float("nan")] * 24, 0), (2060, [None] * 24, 0), (2080, [1.0] * 3, 0), (2100, [], 0), (None, [1.0] * 24, 0), (0, rows[0][1], 0)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = vectors.astype(float)
    found = []
    assert set(got) == set(range(0, 1500, 20))
    for q, rows in got.items():
        scores = x @ x[q]
        best = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        assert [r for r, _, _ in rows] == list(range(1, 21)) and q not in {v for _, v, _ in rows}
        assert np.allclose([s for *_, s in rows], scores[[v for _, v, _ in rows]], rtol=0, atol=1e-9)
        found.append(len({v for _, v, _ in rows} & set(best)) / 20)
        if 100 <= q < 700:
            assert [v for _, v, _ in rows] == best
    assert np.mean(found) >= 0.9


def test_few_and_no_neighbours(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = neighbours.nearest(frame, F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(rows)] == [(1, 1, 0.5), (2, 2, 0.0)]
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).collect() == []


def test_fingerprints(spark):
    docs = documents(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = sorted(fingerprints.compare_neighbours(docs).collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.n_chars, r.edited_sha256))
    want = []
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        a, e, b = fingerprints.digests([text.encode(), edited.encode(), after.encode()])
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), e.tobytes().hex(), fingerprints.likeness(a, e), fingerprints.likeness(a, b)))
    want.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r) for r in got] == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.compare_neighbours(empty(spark)).collect() == []


def test_ranges_of_neighbours(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BYTES_PER_RANGE", 300)
    rng = random.Random(5)
    rows = {i * 7: words(rng, rng.randint(0, 60)) for i in range(80)}
    got = {r.doc_id: r for r in fingerprints.compare_neighbours(spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)).collect()}
    order = sorted(rows, reverse=True)
    for k, i in enumerate(order):
        after = rows[order[(k + 1) % len(order)]]
        n = len(rows[i]) // 3
        assert got[i].edited_sha256 == hashlib.sha256((rows[i][: len(rows[i]) - n] + after[:n]).encode()).hexdigest()


def test_a_fingerprint_does_not_depend_on_its_company():
    some = [(t or "").encode() for t in texts()] + [words(random.Random(9), 3000).encode()]
    together = fingerprints.digests(some)
    assert all(fingerprints.digests([t])[0].tobytes() == d.tobytes() for t, d in zip(some, together, strict=True))
    assert fingerprints.likeness(together[-1], together[-1]) == 1.0
