"""Conversation structure repair: the cheapest edits that make a conversation's roles regular.

A regular conversation is empty, or an optional system row and then pairs of a user and an assistant row.
Rows are kept (K, 0), get the role user or assistant (R, 2) or are deleted (D, 3; blank and duplicate rows must
be); rows with an empty text may be inserted anywhere (I, 2); a truncated row that stays adds 1.

*Method.* The nodes of a directed acyclic graph are the places before, between and after the rows, each with what the roles
so far allow next, and with the inserts made at this place. A path's weight is one big integer: its high digits are the
cost, its low digits, of a fixed width, are the audit letters from the first place on, zero after the last. So integers
compare as (cost, audit) do, a shorter audit before its continuations, and an ordinary minimum over integers, from
the last place to the first, decides cost and ties at once. The letters fix the roles of changed and new rows.

*On Spark.* Damage and the parts of a row that matter are column expressions. "Seen earlier" is a minimum per conversation, role
and text, combined before the shuffle. Conversations are then read as sorted streams: first one code per row, from which the
graph is solved; then the texts, hashed as they pass, after their conversation's audit. So no task holds a conversation's texts: it
holds one code and four decisions per row, about as much as the audit, which is one value of the result. The integers of
a conversation of n rows have about 8 n bits, so its time grows with n * n / 8 bytes; other conversations are other tasks' work.

Defined cases: a null text or role is one space, a null id or turn is one space in the key of the damage; null turns
come first and are no turns in ``gaps``; a null conversation is one of its own. Rows of one turn are ordered by role and text.
A role that does not begin with s, u or a can't be kept. Repeated rows are duplicates. Very long texts
pass one by one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches, stash, table

#: What the roles so far allow: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The next state by state and initial.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (START, ASSISTANT)
#: The initial that an edit gives where it may choose.
GIVEN = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}
RECAST, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = "DIKR"
DIGIT = 3
#: Faults of a row.
FINE, BLANK, DUPLICATE, CUT = range(4)
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"


def repair(initials: str, faults: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, the ASCII-least audit among them."""
    n = len(initials)
    # deleting all costs DELETE * n, and two inserts end a conversation, so no best path has more inserts than this
    width = DIGIT * (n + DELETE * n // INSERT + 4)
    low = (1 << width) - 1
    step = {x: (1 + LETTERS.index(x)) << (width - DIGIT) for x in LETTERS}

    def edge(letter: str, cost: int, rest: int) -> int:
        """The weight of a path that begins with a letter: the letters after it move back by one place."""
        return ((rest >> width) + cost << width) + step[letter] + ((rest & low) >> DIGIT)

    endless = (DELETE + INSERT) * (n + 2) << width

    def with_inserts(after: list[int], made: list[str]) -> tuple[list[int], list[str]]:
        best, letters = list(after), list(made)
        for _ in range(2):  # a third insert at one place would come back to a state it had
            more = [min(w, edge("I", INSERT, best[NEXT[s][GIVEN[s]]])) for s, w in enumerate(after)]
            letters = [m if b == w else "I" for m, b, w in zip(made, more, after, strict=True)]
            best = more
        return best, letters

    best, letters = with_inserts([0 if s in ENDS else endless for s in range(4)], [""] * 4)
    decided = [letters]
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        extra = TRUNCATED if fault == CUT else 0
        here, made = [], []
        for s in range(4):
            options = {edge("D", DELETE, best[s]): "D"}
            if fault in (FINE, CUT):
                options[edge("R", RECAST + extra, best[NEXT[s][GIVEN[s]]])] = "R"
                if initial in NEXT[s]:
                    options[edge("K", extra, best[NEXT[s][initial]])] = "K"
            here.append(min(options))
            made.append(options[here[-1]])
        best, letters = with_inserts(here, made)
        decided.append(letters)
    audit, state, at = [], START, 0
    while letter := decided[n - at][state]:
        audit.append(letter)
        if letter != "D":
            state = NEXT[state][initials[at] if letter == "K" else GIVEN[state]]
        at += letter != "I"
    return best[START] >> width, "".join(audit)


def edited_lines(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[bytes]:
    """The lines of the repaired conversation, from its rows' roles and texts."""
    state = START
    for letter in audit:
        if letter == "I":
            role, text = NAMES[GIVEN[state]], ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            role = NAMES[GIVEN[state]] if letter == "R" else role
        state = NEXT[state][role[0]]
        yield f"{role}:{text}".encode()


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of the damaged rows; a dropped one stays, with ``gone``, for its conversation."""
    own = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    hurt = own.withColumn("kind", kind).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    )
    return hurt.drop("again")


#: Spark sorts nulls first.
ORDER = ["turn", "role", "text"]


def _digest() -> Column:
    return F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``, but for repeats within a turn, which ``repairs`` sees side by side."""
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    said = rows.withColumn("said", _digest())
    # the turn as a struct, so that a null one is the least
    firsts = said.filter("not gone").groupBy("conv_id", "said").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    firsts = firsts.filter("first <> last").select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    seen = said.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")), "left")
    again = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    fault = F.when(left == "", BLANK).when(again, DUPLICATE).when(F.right(left, F.lit(1)).isin(*STOPS), FINE).otherwise(CUT)
    return seen.withColumn("fault", fault).drop("_conv", "_said", "first")


def _streams(batches: Iterator[pa.RecordBatch], fold: Callable) -> Iterator[pa.RecordBatch]:
    """Rows that ``fold`` makes of each conversation of sorted batches; it is given an iterator of row tuples."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    ahead = next(rows, None)
    out: list[dict] = []
    while ahead is not None:
        conv = ahead[0]

        def own() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                row, ahead = ahead, None
                yield row
                ahead = next(rows, None)

        group = own()
        out.append({"conv_id": conv} | fold(group))
        for _ in group:
            pass
        if len(out) == 1_000:
            yield pa.RecordBatch.from_pylist(out)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out)


REPAIRS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from (conv_id, turn, initial, said, fault, gone) in order."""

    def fold(rows: Iterator[tuple]) -> dict:
        initials, faults, turns, least, most, before = [], bytearray(), 0, None, None, None
        for _, turn, initial, said, fault, gone in rows:
            if gone:
                continue
            if turn is not None:
                turns += turn != most
                least, most = turn if least is None else least, turn
            if before == (turn, said) and fault != BLANK:
                fault = DUPLICATE
            before = (turn, said)
            initials.append(initial if initial in ("s", "u", "a") else "?")
            faults.append(fault)
        joined = "".join(initials)
        cost, audit = repair(joined, bytes(faults))
        return {
            "gaps": 0 if least is None else most - least + 1 - turns,
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
            "illegal": sum(joined[k : k + 2] not in ("su", "ua", "au") for k in range(len(joined) - 1)),
            "cost": cost, "audit": audit,
        }

    for batch in _streams(batches, fold):
        yield batch.cast(pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in batch.schema.names]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every repaired conversation, from its audit (as a text) and then its rows, in order."""

    def fold(rows: Iterator[tuple]) -> dict:
        digest, first = hashlib.sha256(), True
        _, _, audit = next(rows)
        for line in edited_lines(audit, ((role, text) for _, role, text in rows)):
            digest.update(line if first else b"\n" + line)
            first = False
        return {"repaired_sha256": digest.hexdigest()}

    for batch in _streams(batches, fold):
        yield batch.cast(pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))


def _dealt(rows: DataFrame, *order) -> DataFrame:
    """Every conversation in one partition, in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of the repaired rows of every conversation; ``rows`` as after ``damage``."""
    small_batches(rows.sparkSession)
    rows = stash(with_faults(rows), "turns")
    sorted_rows = _dealt(rows.select("conv_id", "turn", "role", "text", "said", "fault", "gone"), *ORDER)
    codes = sorted_rows.select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "said", "fault", "gone")
    found = stash(codes.mapInArrow(_repairs, REPAIRS), "repairs")
    # an audit comes before the rows of its conversation
    texts = rows.filter("not gone").select("conv_id", F.lit(1).alias("place"), "turn", "role", "text")
    audits = found.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = _dealt(audits.unionByName(texts), "place", *ORDER).select("conv_id", "role", "text")
    hashes = stream.mapInArrow(_hashed, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "_conv")
    return found.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def op12_conversations(spark, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")))
