"""SimHash fingerprints and their links against brute force."""

import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.data import documents, empty, words
from tideline.llm import simhash


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """The component label of each fingerprint, all pairs compared."""
    label = {p: p for p in prints}
    for x, y in itertools.combinations(list(label), 2):
        if (x ^ y).bit_count() <= 2 and label[x] != label[y]:
            old, new = label[x], label[y]
            label = {p: new if c == old else c for p, c in label.items()}
    return label


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints)
    out = []
    for (doc_id, _), p in zip(rows, prints, strict=True):
        ids = [i for (i, _), q in zip(rows, prints, strict=True) if label[q] == label[p] and i is not None]
        out.append((doc_id, f"{p:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, simhash.link_documents(df).collect()), key=repr)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_few_bits_are_outside_some_mask(radius):
    masks = simhash.covering_masks(radius, 24)
    for some in itertools.combinations(range(24), radius):
        assert any(not any(m >> b & 1 for b in some) for m in masks)


def test_documents(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == brute(rows)


def test_near_texts_and_repeated_ids(spark):
    rng = random.Random(3)
    base = words(rng, 400).split()
    rows = [(100 + k, " ".join(base[:j] + [words(rng, 1)] + base[j + 1 :])) for k, j in enumerate(rng.sample(range(400), 60))]
    rows += [(7, " ".join(base)), (7, "other text"), (None, " ".join(base)), (None, "alone " * 9), (5, None), (6, " \n")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("together", [2, 16])
def test_links_in_crowded_and_small_buckets(spark, monkeypatch, together):
    monkeypatch.setattr(simhash, "TOGETHER", together)
    rng = random.Random(together)
    prints = set()
    for _ in range(30):
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 60])):
            prints.add(p)
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4])):
                p ^= 1 << b
    rows = [(simhash._signed(p),) for p in prints]
    nodes = spark.createDataFrame(rows, "fp long").select(F.struct("fp").alias("node"))
    label, want = {}, brute_components(prints)
    for r in simhash.links(nodes).collect():
        a, b = r.a.fp % 2**64, r.b.fp % 2**64
        assert want[a] == want[b]
        x, y = label.setdefault(a, a), label.setdefault(b, b)
        label = {p: x if c == y else c for p, c in label.items()}
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(label.get(p, p))
    assert all(len(g) == 1 for g in groups.values())


def test_a_very_long_text_is_worked_on_in_stretches(monkeypatch):
    text = words(random.Random(5), 3_000) + " \t\n " + "x" * 500 + "  end"
    want = brute_print(text)
    for size in (1, 7, 100, 10_000):
        monkeypatch.setattr(simhash, "word_lists", lambda t, size=size, lists=WORD_LISTS: lists(t, size))
        assert simhash.fingerprint(text.encode()) == want


WORD_LISTS = simhash.word_lists


def test_an_empty_table(spark):
    assert got(empty(spark)) == []
