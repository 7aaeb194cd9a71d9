"""Small tables for the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names that operators use themselves.
CLASHING = ["digest", "shard", "chunk", "kept", "n_bytes", "score", "epoch", "domain", "key", "cls", "comp", "tag", "bucket", "block", "range", "word"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "the", "er", "ti", "on", "re", "st", "ou"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Prose with exact copies, near copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = words(rng, 120)
    out: list[str | None] = [None, "", " \t\n", "a", "One two", "one  TWO", "é" * 30, "ab" * 200, "x y z w v", "x y z w v u"]
    for k in range(n):
        kind = k % 6
        if kind == 0:
            out.append(words(rng, rng.randint(1, 300)))
        elif kind == 1:
            out.append(base)
        elif kind == 2:
            some = base.split()
            for _ in range(rng.randint(1, 6)):
                some[rng.randrange(len(some))] = words(rng, 1)
            out.append(" ".join(some))
        elif kind == 3:
            out.append(words(rng, 30) + "\n" + passage + "\n" + words(rng, 20))
        elif kind == 4:
            out.append(words(rng, 12) + " Ünïcode 漢字 " + words(rng, rng.randint(0, 8)))
        else:
            out.append("\n".join([words(rng, 8)] * rng.randint(1, 9)))
    return out


def documents(spark: SparkSession, seed: int = 1, n: int = 60, odd: bool = True) -> DataFrame:
    """Documents; ``odd`` adds a null id, a repeated row and clashing columns."""
    rows = [(i, t, ["en", "de", None][i % 3], ["src0", "src0", "src1", None][i % 4], len(t or "")) for i, t in enumerate(texts(seed, n))]
    if odd:
        rows += [rows[11], rows[11], (None, rows[11][1], None, None, 5), (None, "null id " * 20, "en", "src2", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    if odd:
        for c in CLASHING:
            df = df.selectExpr("*", f"1 AS `{c}`")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
