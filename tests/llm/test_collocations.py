"""Collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.data import documents, empty
from tideline.llm import collocations as co


def brute(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts[lang].update(tuple(w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, c in f.items() if len(p) > 1 and c >= least]
        scored = []
        for p in found:
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and f[q] >= f[p] and inside(q) for q in found):
                continue
            score, _, l, r = min((1000 * f[p] * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            scored.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed, n=300):
    """Texts of few words, with set phrases, in three languages, one of them null."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ü1", "漢字", "x y", "-"]
    fixed = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 7))] for _ in range(12)]
    rare = [[f"r{k}a", f"R{k}b", "w1", f"r{k}c"][: rng.randint(2, 4)] for k in range(10)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += rng.choice([[rng.choice(vocabulary)], rng.choice(fixed), rng.choice(rare), ["a", "b", "a", "b"]])
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", " \x0b", "!?"]) for w in words)
        rows.append((["en", "en", "de", None][k % 4], text))
    return [*rows, ("en", None), ("en", ""), ("und", "w1 w2"), ("xx", "..., !"), ("en", "w1 w2 w3 " * 2_000), (None, "one\ttwo. " * 60)]


def got(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS word", "2 AS m", "3 AS tag", "4 AS h").repartition(3)
    return sorted(map(tuple, co.collocations(docs, **options).collect()))


@pytest.mark.parametrize("least, top, first_part", [(5, 2_000, 0.1), (3, 4, 0.02), (8, 15, 0.3)])
def test_rounds_find_what_counting_all_finds(spark, least, top, first_part):
    rows = corpus(least)
    assert got(spark, rows, least=least, top=top, first_part=first_part) == brute(rows, least, top)


def test_rests_of_unopened_words_and_bounds(spark, monkeypatch):
    rounds = []
    grow = co.Miner.grow
    monkeypatch.setattr(co.Miner, "grow", lambda self, opened: rounds.append(opened.count()) or grow(self, opened))
    rng = random.Random(2)
    # rare phrases score far above what begins with common words, so these are never opened
    rows = [("en", " ".join(["the", rng.choice("abcd")] * 30 + [f"x{k % 9} the y{k % 9}", "."])) for k in range(200)]
    assert got(spark, rows, least=10, top=5, first_part=0.01) == brute(rows, 10, 5)
    assert len(rounds) == 1


def test_long_texts_are_cut_between_pieces(spark):
    rng = random.Random(8)
    text = " ".join(rng.choice(["alpha", "beta", "gamma,", "delta", "eps.", "z\n"]) for _ in range(400_000))
    rows = [("en", text), ("de", "no stops here " * 30_000)]
    assert got(spark, rows, least=100, top=50) == brute(rows, 100, 50)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert sorted(map(tuple, co.collocations(docs, least=4, top=30).collect())) == brute(rows, 4, 30)
    assert co.collocations(docs, least=10**6).collect() == []


def test_an_empty_table(spark):
    assert co.collocations(empty(spark)).collect() == []


def test_quotients_keep_all_digits(spark):
    rows = [(10**14 + 7, 9 * 10**14 + 11, 10**14 + 9, 3 * 10**13 + 1), (100, 10**15, 100, 100), (3, 7, 2, 2)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    out = df.select(co._quotient(df.a, df.n, df.l, df.r)).collect()
    assert [r[0] for r in out] == [1000 * a * n // (l * r) for a, n, l, r in rows]
