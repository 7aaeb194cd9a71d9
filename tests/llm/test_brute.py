"""Statistics, entropies, features, placement and pipeline stages against plain versions of them."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, documents, texts, words
from tests.llm.test_near import brute_components, brute_repeats
from tests.llm.test_text import brute_mix
from tideline.llm import fingerprints, html, jaccard, mixing, packing, repeats, rules, sharding, stages

SF = "/root/testdata/sf0.001"


def plain_statistics(text):
    found = lambda p: len(regex.findall(p, text))
    w = [x for x in regex.split(r"[ \t\n\x0b\f\r]+", text) if x]
    lines = text.split("\n")
    n, c, k = max(len(w), 1), max(len(text), 1), len(lines)
    marks = set("#$%&*@^~<>{}[]\\=+_")
    return {
        "log_chars": math.log1p(len(text)), "mean_word": c / n, "words_per_line": n / k, "distinct_words": len(set(w)) / n,
        "distinct_lines": len(set(lines)) / k, "upper": found(r"\p{Lu}") / c, "digits": sum(x in "0123456789" for x in text) / c,
        "symbols": sum(x in marks for x in text) / c, "exclaim": (text.count("!") + text.count("?")) / n, "bars": text.count("|") / n,
        "stops": sum(a == "." and (b == "" or b in " \t\n\x0b\f\r") for a, b in zip(text, [*text, ""][1:], strict=True)) / n, "commas": text.count(",") / n,
        "short_words": sum(len(x) <= 3 for x in w) / n, "long_words": sum(len(x) >= 16 for x in w) / n,
    }


def test_statistics_of_texts(spark):
    some = [t or "" for t in texts()] + ["End. Of. it! a|b, c 12 #$ ÄÖ\nx\nx", "word, " * 30_000 + "."]
    frame, names = rules.with_statistics(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"))
    for r in frame.collect():
        got, want = dict(zip(names, r._stats, strict=True)), plain_statistics(some[r.doc_id])
        assert {k: got[k] for k in want} == pytest.approx(want, abs=1e-12), some[r.doc_id][:50]


def test_lasso_meets_the_conditions_of_the_optimum():
    rng = np.random.default_rng(3)
    x = (rng.random((600, 25)) < 0.4).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1] + 0.2)))).astype(float)
    penalty = 0.02
    bias, w = rules.lasso(x, y, penalty, steps=4000)
    err = 1 / (1 + np.exp(-(bias + x @ w))) - y
    slope = x.T @ err / len(y)
    assert abs(err.mean()) < 1e-5 and 0 < np.count_nonzero(w) < 25
    assert np.all(np.abs(slope[w == 0]) <= penalty + 1e-5)
    assert np.allclose(slope[w != 0], -penalty * np.sign(w[w != 0]), atol=1e-5)


def test_importance_of_styles(spark):
    rng = random.Random(8)
    rows = []
    for i in range(24):
        body = "".join(f"<p>{words(rng, 5) if rng.random() < 0.6 else 'the same'}</p>" for _ in range(rng.randint(1, 3)))
        rows.append((i, f"http://h{i % 2}.example/{i}", f"<body><div class=top>menu</div><div class=in>{body}</div></body>"))
    rows += [rows[3], (90, *rows[3][1:])]  # copies count once
    held = defaultdict(dict)
    for _, url, page in rows:
        blocks, nodes = html.parse(page)
        seen = tuple((s.path, t) for t, s in blocks)
        held[url.split("/")[2]][seen] = (set(seen), {(n.path, tuple(n.children)) for n in nodes})
    want = {}
    for host, pages in held.items():
        contents, shapes = Counter(x for c, _ in pages.values() for x in c), Counter(x for _, s in pages.values() for x in s)
        for path in {p for p, _ in contents}:
            c, s = [n for (p, _), n in contents.items() if p == path], [n for (p, _), n in shapes.items() if p == path]
            m = sum(s)  # pages that have the node with one sequence of children, or several
            content = max(0.0, 1 - sum(n * math.log(n) for n in c) / sum(c) / math.log(max(m, 2)))
            shown = -sum(n / m * math.log(n / m, m) for n in s) if m > 1 else 1.0
            want[host, html._hash(path)] = 0.8 * content + 0.2 * shown
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {(r.host, r.path): r.importance for r in html.style_importance(frame).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def plain_chain(data):
    """Filters as sets of bits, with the count of their features; window by window."""
    def rarity(w):
        total = sum(round(n * math.log2(n) * 2**14 / 64) for n in Counter((b * 2654435761 % 2**32 >> 20) & 15 for b in w).values())
        return abs((6 << 14) - total - 3 * 2**14)

    def hashed(w):
        h = 0x243F6A8885A308D3
        for k in range(0, 64, 8):
            h = (h ^ int.from_bytes(w[k : k + 8], "little")) * 0x9E3779B97F4A7C15 % 2**64
            h ^= h >> 29
        h = (h ^ h >> 32) * 0x9E3779B97F4A7C15 % 2**64
        return h ^ h >> 31

    rare = [rarity(data[i : i + 64]) for i in range(len(data) - 63)]
    wins = Counter(max(range(i, i + 64), key=lambda k: (rare[k], -k)) for i in range(len(rare) - 63))
    at = sorted(i for i, n in wins.items() if n >= 16)
    if not at and rare:
        at = [rare.index(max(rare))]
    features = [hashed(data[i : i + 64]) for i in at]
    if 0 < len(data) < 256:
        grams = {data[i : i + 8] for i in range(max(1, len(data) - 7))}
        features += sorted(int.from_bytes(hashlib.blake2b(g, digest_size=8).digest(), "little") for g in grams)
    features = list(dict.fromkeys(features))
    chain = [features[k : k + 160] for k in range(0, len(features), 160)]
    return [({h >> 11 * k & 2047 for h in part for k in range(5)}, len(part)) for part in chain]


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    a, b = sorted((a, b), key=len)

    def alike(x, y):
        most, chance = min(len(x), len(y)), len(x) * len(y) / 2048
        floor = chance + 0.15 * (most - chance)
        return min(1, max(0, (len(x & y) - floor) / max(most - floor, 1e-9)))

    return sum(n * max(alike(x, y) for y, _ in b) for x, n in a) / sum(n for _, n in a)


def test_features_and_likeness_window_by_window():
    rng = random.Random(11)
    long_text = words(rng, 5000)
    some = [(t or "").encode() for t in texts(n=36)] + [long_text.encode(), (long_text[:20_000] + words(rng, 900)).encode()]
    chains = [plain_chain(t) for t in some]
    got = fingerprints.digests(some)
    for chain, digest in zip(chains, got, strict=True):
        bits = [set(np.flatnonzero(row).tolist()) for row in np.unpackbits(digest[:, :-2], axis=1)]
        assert list(zip(bits, [int.from_bytes(row[-2:].tobytes(), "little") for row in digest], strict=True)) == chain
    pairs = [(i, j) for i in range(len(some)) for j in range(i) if len(chains[i]) != len(chains[j]) or i < 20 or i > 44]
    for i, j in pairs:
        likes = {plain_likeness(chains[i], chains[j]), plain_likeness(chains[j], chains[i])}  # of equal lengths either may be first
        assert any(fingerprints.likeness(got[i], got[j]) == pytest.approx(x, abs=1e-6) for x in likes)


@pytest.mark.parametrize("most", [3, 50_000])
def test_hot_and_null_ids_are_cut_into_ranges(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprints, "BYTES_PER_RANGE", 500)
    monkeypatch.setattr(fingerprints, "MOST_RANGES", most)
    rng = random.Random(12)
    rows = [(rng.choice([None, 5, 5, rng.randrange(-9, 60)]), words(rng, rng.randint(0, 40))) for _ in range(240)]
    rows += [(2**63 - 1, "top"), (-(2**63) + 1, "low"), (7, words(rng, 40_000)), (7, None), (5, "same"), (5, "same")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    if most > 3:
        keyed = frame.selectExpr("coalesce(~doc_id, 9223372036854775807) AS key", "doc_id", "coalesce(text, '') AS text")
        ranges = fingerprints._in_ranges(keyed).filter("doc_id = 5 or doc_id is null").groupBy("doc_id").agg(F.countDistinct("range").alias("n"))
        assert all(r.n > 2 for r in ranges.collect())
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        n = len(t) // 3
        edited = t[: len(t) - n] + order[(k + 1) % len(order)][1][:n]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    got = fingerprints.compare_neighbours(frame).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_placement_of_groups_one_by_one(spark):
    rng = random.Random(13)
    rows = [(i, words(rng, rng.randint(1, 90))) for i in range(70)] + [(100 + i, "copied text here") for i in range(9)] + [(200, words(rng, 700)), (201, None)]
    n = 4
    groups = defaultdict(lambda: [0, 0, 0])
    for _, t in rows:
        g = groups[hashlib.md5((t or "").encode()).digest()]
        for k, x in enumerate((len((t or "").encode()) + 8, len((t or "").split()), 1)):
            g[k] += x
    total = [sum(g[k] for g in groups.values()) for k in range(3)]
    room = [x / n for x in total]
    pieces = {d: 8 * max(math.ceil(x / r) for x, r in zip(g, room, strict=True)) for d, g in groups.items()}
    assert all(p == 8 for p in pieces.values())  # no group is larger than a shard
    left = [[room[0] * sharding.SLACK, room[1], room[2]] for _ in range(n)]
    where = {}
    large = {d: g for d, g in groups.items() if max(x / r for x, r in zip(g, room, strict=True)) >= 1 / 64}
    for d, g in sorted(sorted(large.items()), key=lambda x: -x[1][0]):
        fits = [s for s in range(n) if left[s][0] >= g[0]] or None
        score = lambda s: sum(w * g[k] * left[s][k] / room[k] ** 2 for k, w in enumerate((0.6, 0.2, 0.2))) if fits else left[s][0]  # noqa: B023, E731
        best = max(fits or range(n), key=lambda s: (round(score(s), 12), -s))
        where[d] = best
        left[best] = [a - b for a, b in zip(left[best], g, strict=True)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), n).collect()
    text = dict(rows)
    shards = {hashlib.md5((text[r.doc_id] or "").encode()).digest(): r.shard for r in got}
    assert len(got) == len(rows) and {d: shards[d] for d in where} == where and len(where) > 40


def collected(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_rows_that_the_stages_keep(spark):
    """Every stage on the odd documents, each held against a plain version of its decision."""
    docs = documents(spark).unionByName(spark.createDataFrame([(500, "long text " * 40_000, "en", "src0", 400_000)], SCHEMA), allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]

    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = rules.train(docs, labels)
    stats, _ = rules.with_statistics(docs)
    marks = [(r.doc_id, r.text, model.predict(np.array([r._stats]))[0]) for r in stats.select("doc_id", "text", "_stats").collect()]
    kept = rules.score_documents(docs, model).filter("predicted = 1")
    assert collected(kept) == sorted(((i, t) for i, t, p in marks if p >= 0.3), key=repr)

    # near copies: the smallest id of each component; of a repeated row one
    comp = {(i, t): c for (i, t), c in zip(rows, [next(c for j, n, c in brute_components(rows) if j == i) for i, _ in rows], strict=True) if i is not None}
    want = {(i, t) for (i, t), c in comp.items() if c == i}
    got = collected(stages.keep_one_of_each(spark, docs, SF))
    assert got == sorted([*want, *[(i, t) for i, t in rows if i is None]], key=repr)

    # repeated passages: the operator's bytes, in whole characters
    plain = {(i, n): (gone, sha) for i, n, gone, _, sha in brute_repeats(rows)}
    out = {r.doc_id: r for r in stages.cut_repeats(spark, docs, SF).collect() if r.doc_id is not None}
    for i, t in rows:
        if i is None:
            continue
        size = len((t or "").encode())
        gone, sha = plain[i, size]
        if gone == size > 0:
            assert i not in out
        elif gone == 0:
            assert out[i].text == t
        elif (t or "").isascii():
            assert hashlib.sha256(out[i].text.encode()).hexdigest() == sha and out[i].n_chars == len(out[i].text)

    unique = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    paths = []
    for r in unique.collect():
        s = r.source or ""
        domain = "web" if s[-1:] in "0369" and s else "books" if s[-1:] in "147" and s else "forums"
        paths.append((r.doc_id, r.doc_id, len((r.text or "").encode().split()), (domain, r.lang or "", s)))
    mixed = Counter(r.doc_id for r in stages.mix_sources(spark, unique, SF).collect())
    assert mixed == brute_mix(paths, stages.MIX_PART, mixing.WEIGHTS, mixing.LANG_WEIGHTS, 1)

    sizes = defaultdict(int)
    for r in stages.pack(spark, unique, SF).collect():
        sizes[r.doc_id] += r.length
    assert sizes == {r.doc_id: len(packing.encode(r.text or "")) + 1 for r in unique.select("doc_id", "text").collect()}


def test_very_long_texts(spark):
    rng = random.Random(14)
    base = words(rng, 60_000)
    changed = base.split()
    changed[::2000] = ["other"] * len(changed[::2000])
    rows = [(1, base), (2, " ".join(changed)), (3, words(rng, 50)), (4, base[:300_000]), (5, "x" * 400_000)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, jaccard.link_documents(docs).collect()), key=repr) == brute_components(rows)
    cut = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, cut), key=repr) == brute_repeats(rows)
    assert sorted(r.doc_id for r in mixing.mix(docs, 1.0, max_epochs=1).collect()) == [1, 2, 3, 4, 5]
    assert {r.doc_id: r.bytes for r in sharding.assign_shards(docs, 2).collect()} == {i: len(t.encode()) + 8 for i, t in rows}
