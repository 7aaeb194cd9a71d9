"""Conversation repair against an enumeration of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tideline.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
INSERTS = ["", "u", "a", "ua", "au"]


def all_edits(rows):
    """The least (cost, audit) and its repaired lines, over every edit of (role, text, fault) rows."""
    best, lines = None, set()
    choices = [["D"] if f in (cv.BLANK, cv.DUPLICATE) else ["D", "K", "u", "a"] for _, _, f in rows]
    for edits in itertools.product(*choices):
        for inserts in itertools.product(INSERTS, repeat=len(rows) + 1):
            cost = 2 * sum(map(len, inserts))
            audit, roles, out = "I" * len(inserts[0]), inserts[0], [(x, "") for x in inserts[0]]
            for (role, text, fault), e, more in zip(rows, edits, inserts[1:], strict=True):
                if e == "D":
                    cost, audit = cost + 3, audit + "D"
                else:
                    cost += (fault == cv.CUT) + (0 if e == "K" else 2)
                    audit += "K" if e == "K" else "R"
                    roles += role[:1] if e == "K" and role[:1] else "?" if e == "K" else e
                    out.append((role if e == "K" else e, text))
                audit, roles, out = audit + "I" * len(more), roles + more, out + [(x, "") for x in more]
            if best and (cost, audit) > best or not re.fullmatch("(s?(ua)+)?", roles):
                continue
            if (cost, audit) != best:
                best, lines = (cost, audit), set()
            lines.add("\n".join(f"{dict(u='user', a='assistant').get(r, r)}:{t}" for r, t in out))
    assert len(lines) == 1
    return *best, lines.pop()


def tuple_paths(initials, faults):
    """(cost, audit) with texts in place of integers, for conversations too long for all edits."""
    after = {"": ("", (0, "")), "a": ("", (0, ""))}
    states, nxt = ["", "s", "u", "a"], {"": "su", "s": "u", "u": "a", "a": "u"}
    worst = (10**9, "")
    value = {s: after[s][1] if s in after else worst for s in states}

    def insert(v):
        for _ in range(3):
            v = {s: min(v[s], (v[nxt[s][-1]][0] + 2, "I" + v[nxt[s][-1]][1])) for s in states}
        return v

    value = insert(value)
    for x, f in zip(reversed(initials), reversed(faults), strict=True):
        new = {}
        for s in states:
            options = [(value[s][0] + 3, "D" + value[s][1])]
            if f in (cv.FINE, cv.CUT):
                t = value[nxt[s][-1]]
                options.append((t[0] + 2 + (f == cv.CUT), "R" + t[1]))
                if x and x in nxt[s]:
                    options.append((value[x][0] + (f == cv.CUT), "K" + value[x][1]))
            new[s] = min(options)
        value = insert(new)
    return value[""]


def brute(rows):
    """The whole query in plain Python."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append(cv.BLANK if not body else cv.DUPLICATE if (role, text) in seen else cv.FINE if body[-1] in ".!?" else cv.CUT)
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        joined = [r[:1] for _, r, _ in mine]
        if len(mine) <= 3:
            cost, audit, text = all_edits([(r, t, f) for (_, r, t), f in zip(mine, faults, strict=True)])
        else:
            cost, audit = tuple_paths(joined, faults)
            text = replay(audit, mine)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in (cv.BLANK, cv.DUPLICATE, cv.CUT)),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(joined)), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def replay(audit, rows):
    lines, left, last = [], list(rows), ""
    for x in audit:
        role, text = (None, "") if x == "I" else left.pop(0)[1:]
        if x == "D":
            continue
        if x in "IR":
            role = "assistant" if last == "u" else "user"
        lines.append(f"{role}:{text}")
        last = role[0]
    return "\n".join(lines)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS audit", "2 AS fault", "3 AS said", "4 AS kind").repartition(3)
    out = cv.repair_conversations(cv.damage(df))
    return sorted(map(tuple, out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def test_integers_decide_as_all_edits_do():
    for roles in itertools.chain.from_iterable(itertools.product(["system", "user", "assistant", "tool"], repeat=n) for n in range(4)):
        rng = random.Random(repr(roles))
        rows = [(r, f"t{k}", rng.choice([cv.FINE, cv.FINE, cv.BLANK, cv.DUPLICATE, cv.CUT])) for k, r in enumerate(roles)]
        cost, audit = cv.repair("".join(r[0] for r in roles), bytes(f for _, _, f in rows))
        text = b"\n".join(cv.edited_lines(audit, ((r, t) for r, t, _ in rows))).decode()
        assert (cost, audit, text) == all_edits(rows)


@pytest.mark.parametrize("n", [4, 9, 40, 300])
def test_longer_conversations(n):
    rng = random.Random(n)
    for _ in range(20):
        initials = "".join(rng.choice("suuaa?") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert cv.repair(initials, faults) == tuple_paths(initials, faults)


def test_conversations(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "what", "", " \t\n", "Why? ", "ü漢.", "cut off,\x0b", None]
    roles = ["user", "assistant", "user", "assistant", "system", "", None, "Tool"]
    rows = []
    for conv in [*range(60), None]:
        for k in range(rng.choice([1, 2, 3, 3, 5, 9])):
            turn = rng.choice([k, k, k, k + 3, None, 2])
            rows += [(conv, turn, rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 2])
    rows += [(99, t, ["user", "assistant"][t % 2], f"line {t}.") for t in range(500)]
    rows += [(98, 0, "user", "long. " * 50_000), (98, 1, "assistant", "x" * 300_000)]
    # dropped rows leave their conversation
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "gone.")]
    out = got(spark, rows)
    assert out == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in out


def test_an_empty_table(spark):
    assert got(spark, []) == []


def test_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = cv.op12_conversations(spark, "/root/testdata/sf0.001").drop("more").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
