"""Phrase collocations by best-first branch-and-bound growth.

A phrase of 2 to 5 words with ``a`` occurrences scores the least, over its cuts into a first part with ``l`` and a
rest with ``r`` occurrences, of ``1000 * a * n / (l * r)``; ``n`` counts all words of its language.

*Bound.* The rest of a phrase occurs at least as often as the phrase, so ``1000 * n / l`` bounds every phrase
that grows from a first part: nothing that begins with the word ``w`` can reach more than ``1000 * n / f(w)``. The
frontier holds the first words, the rarest first, as their bounds are highest.

*Rounds.* A round takes the best first words of each language off the frontier and grows phrases from them, longer ones
from counted first parts only. Then the score of the language's last wanted surviving phrase is a threshold. The next round
opens every word whose bound reaches it, ties included; as the threshold only rises, what is left after that can't
matter. A language with too few phrases has the threshold zero, and all its words are opened.

*Counts.* While phrases grow they are counted as 64-bit hashes, combined per task, and prefixes known to be frequent are
handed on as bit sets of bounded size; both can only let too many phrases pass. All that pass are counted
again by their letters, with the least and greatest hash of the words on either side: where both are equal and there is
always such a word, the phrase one word longer occurs as often, which is when a phrase is dropped. (A longer phrase that
occurs as often makes the ones between occur as often, too.) Rests that begin with words not yet
opened are counted by their letters as well. Scores are divided as decimals of 38 digits.

Defined cases: a null text is empty, a null language is ``und``. Repeated rows count each. An empty table, or one without
frequent phrases, gives no rows. A very long text is worked on in stretches that end between pieces.
Ties of a score go to the greater ``a``, then to the phrase's bytes. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import small_batches, stash, table, text_of
from tideline.llm.simhash import word_lists

LEAST, LONGEST, TOP, SCALE = 100, 5, 2_000, 1_000
#: The first round opens the rarest words, up to this part of all words.
FIRST_PART = 0.1
#: Bytes of text that are worked on together; distinct hashes and phrases that a task holds.
STRETCH, HELD, HELD_PHRASES = 1 << 20, 1 << 20, 200_000
#: Bits per entry of a bit set, and its smallest and largest size.
SPARSE, SMALLEST_BITS, LARGEST_BITS = 32, 1 << 20, 1 << 27

STOPS = b".,;:!?\n\x0b\x0c\r"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_WORDS = bytes.maketrans(_UPPER + STOPS, _LOWER + b" " * len(STOPS))
_LETTERS = np.frombuffer(bytes.maketrans(_UPPER, _LOWER), np.uint8)
_STOP, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(STOPS)] = _GAP[list(STOPS + b" \t")] = True
_ANY_STOP = re.compile(b"[" + re.escape(STOPS) + b"]")
_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_PLACE = _rng.integers(0, 2**63, LONGEST, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_FORTH = np.concatenate([[np.uint64(1)], np.full(2 * STRETCH, _BASE)]).cumprod(dtype=np.uint64)
_BACK = np.concatenate([[np.uint64(1)], np.full(2 * STRETCH, _INVERSE)]).cumprod(dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


class Words:
    """The words of a stretch of texts: where they are, their pieces, and hashes that differ between languages."""

    def __init__(self, texts: list[bytes], tags: np.ndarray):
        self.data = _LETTERS[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        edges = np.diff(np.concatenate([[True], _GAP[self.data], [True]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        self.piece = np.cumsum(_STOP[self.data], dtype=np.int32)[self.starts]
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, "right")
        forth, back = (x if len(x) > len(self.data) else np.concatenate([[np.uint64(1)], np.full(len(self.data), x[1])]).cumprod(dtype=np.uint64) for x in (_FORTH, _BACK))
        sums = np.concatenate([[np.uint64(0)], (_BYTE[self.data] * forth[: len(self.data)]).cumsum(dtype=np.uint64)])
        own = (sums[self.ends] - sums[self.starts]) * back[self.starts]
        self.hash = _mix(own + (self.ends - self.starts).astype(np.uint64) * _PLACE[0] ^ tags[self.text])

    def inside(self, at: np.ndarray, m: int) -> np.ndarray:
        """Those of ``at`` at which ``m`` words of one piece begin."""
        at = at[at + m <= len(self.starts)]
        return at[self.piece[at] == self.piece[at + m - 1]]

    def phrase(self, at: np.ndarray, m: int) -> np.ndarray:
        """Hashes of the phrases of ``m`` words that begin at ``at``."""
        return _mix(sum((self.hash[at + k] * _PLACE[k] for k in range(m)), np.uint64(m)))

    def spelled(self, at: int, m: int) -> str:
        return b" ".join(self.data[self.starts[k] : self.ends[k]].tobytes() for k in range(at, at + m)).decode()


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of about ``STRETCH`` bytes of texts, and the language of each text."""
    texts, langs, tags, size = [], [], [], 0
    for batch in batches:
        for text, lang, tag in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "tag")), strict=True):
            text = text.encode()
            while text:
                stop = _ANY_STOP.search(text, STRETCH)
                part, text = (text[: stop.start()], text[stop.end() :]) if stop else (text, b"")
                texts.append(part)
                langs.append(lang)
                tags.append(tag)
                size += len(part) + 1
                if size >= STRETCH:
                    yield Words(texts, np.array(tags, np.int64).view(np.uint64)), langs
                    texts, langs, tags, size = [], [], [], 0
    if texts:
        yield Words(texts, np.array(tags, np.int64).view(np.uint64)), langs


class Marks:
    """Tells of every hash of ``rows`` that it may be among them, and of few others: two bits of a set of bounded size each."""

    def __init__(self, rows: DataFrame, col: str = "h"):
        count = rows.count()
        size = min(max(SMALLEST_BITS, 1 << (SPARSE * count - 1).bit_length() if count else 0), LARGEST_BITS)
        self.mask = size - 1
        places = rows.select(F.explode(F.array(*[F.shiftrightunsigned(col, s).bitwiseAND(F.lit(self.mask)) for s in (0, 32)])).alias("p"))
        found = places.groupBy(F.expr("p div 32768").alias("bucket")).agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect()
        bits = np.zeros(size // 8, np.uint8)  # at most LARGEST_BITS / 8 bytes, 16 MB, come to the driver
        for r in found:
            bits[r.bucket * 4096 : (r.bucket + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
        self.bits = rows.sparkSession.sparkContext.broadcast(bits)

    def holds(self, h: np.ndarray) -> np.ndarray:
        bits, mask = self.bits.value, np.uint64(self.mask)
        out = np.ones(len(h), bool)
        for shift in (0, 32):
            p = (h >> np.uint64(shift)) & mask
            out &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    def drop(self) -> None:
        self.bits.unpersist()


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words, and of all its words of a language under a null word."""
    counts: dict[str, Counter] = {}

    def flushed() -> pa.RecordBatch:
        rows = [(lang, w, c) for lang, words in counts.items() for w, c in words.items()]
        rows += [(lang, None, words.total()) for lang, words in counts.items()]
        counts.clear()
        langs, words, numbers = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], ["lang", "word", "f"])

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            own = counts.setdefault(lang, Counter())
            for words in word_lists(text.encode().translate(_WORDS)):
                own.update(words)
        if sum(map(len, counts.values())) > HELD_PHRASES:
            yield flushed()
    if counts:
        yield flushed()


def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``h``, the hash that ``Words`` gives a phrase."""
    for batch in batches:
        h = np.empty(batch.num_rows, np.uint64)
        tags = batch.column("tag").to_numpy().view(np.uint64)
        phrases = batch.column("phrase").cast(pa.binary()).to_pylist()
        for a in range(0, len(phrases), 10_000):
            words = Words(phrases[a : a + 10_000], tags[a : a + 10_000])
            first, sizes = np.unique(words.text, return_index=True)[1], np.bincount(words.text)
            for m in np.unique(sizes):
                own = first[sizes == m]
                h[a + words.text[own]] = words.phrase(own, m) if m > 1 else words.hash[own]
        yield pa.RecordBatch.from_arrays([*batch.columns, _signed(h)], [*batch.schema.names, "h"])


def hashed(phrases: DataFrame) -> DataFrame:
    tagged = phrases.withColumn("tag", F.xxhash64("lang"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tagged.schema.fields)
    return tagged.mapInArrow(_hash_phrases, f"{fields}, h long").drop("tag")


def _grown(words: Words, opened: Marks, frequent: Marks, known: dict[int, Marks]) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes, and the places at which phrases of that size begin with an opened word and may be frequent."""
    may = frequent.holds(words.hash)
    first = may & opened.holds(words.hash)
    at = np.flatnonzero(first)
    for m in range(2, LONGEST + 1):
        at = words.inside(at, m)
        at = at[may[at + m - 1]]
        size = max((k for k in known if k < m), default=0)
        for k in range(0 if size == m - 1 else m - size, m - size + 1) if size else ():
            # a part of which nothing is known, as its first word is not opened, passes
            fine = ~first[at + k]
            fine[~fine] = known[size].holds(words.phrase(at[~fine] + k, size))
            at = at[fine]
        yield m, at


def _count_hashes(opened: Marks, frequent: Marks, known: dict[int, Marks], sizes: list[int]):
    """Counts of a task's phrases of ``sizes`` words by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in sizes:
            held[m] = (np.empty(0, np.uint64), np.empty(0, np.int64))
        for words, _ in _stretches(batches):
            for m, at in _grown(words, opened, frequent, known):
                if m in sizes:
                    new[m].append(words.phrase(at, m))
                    if sum(map(len, new[m])) > HELD:
                        merge(m)
                        if len(held[m][0]) > HELD:
                            yield flushed(m)
        for m in sizes:
            merge(m)
            yield flushed(m)

    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    new: dict[int, list[np.ndarray]] = {m: [] for m in sizes}

    def merge(m: int) -> None:
        keys, counts = held[m]
        some, times = np.unique(np.concatenate([np.empty(0, np.uint64), *new[m]]), return_counts=True)
        new[m].clear()
        at = np.minimum(np.searchsorted(keys, some), max(len(keys) - 1, 0))
        old = keys[at] == some if len(keys) else np.zeros(len(some), bool)
        counts[at[old]] += times[old]
        keys, counts = np.concatenate([keys, some[~old]]), np.concatenate([counts, times[~old]])
        order = np.argsort(keys, kind="stable")
        held[m] = keys[order], counts[order]

    def flushed(m: int) -> pa.RecordBatch:
        keys, counts = held[m]
        held[m] = (np.empty(0, np.uint64), np.empty(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), m, np.int32)), _signed(keys), pa.array(counts)], ["m", "h", "a"])

    return run


SPELLED = "lang string, m int, phrase string, a long, left_least long, left_most long, right_least long, right_most long"
_MOST = np.iinfo(np.int64).max


def _count_spelled(wanted: dict[int, Marks], frequent: Marks, opened: Marks | None = None):
    """Exact counts of a task's wanted phrases, and the least and greatest hash of the words on either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.uint64), np.empty((0, 5), np.int64), []
        keys, values, names = empty
        for words, langs in _stretches(batches):
            n = len(words.hash)
            side = words.hash.view(np.int64)
            together = words.piece[1:] == words.piece[:-1]
            before, after = np.concatenate([[False], together])[:n], np.concatenate([together, [False]])[:n]
            may = frequent.holds(words.hash)
            first = np.flatnonzero(may if opened is None else may & opened.holds(words.hash))
            for m, marks in sorted(wanted.items()):
                at = words.inside(first, m)
                for k in range(1, m):
                    at = at[may[at + k]]
                h = words.phrase(at, m)
                fine = marks.holds(h)
                at, h = at[fine], h[fine]
                if not len(at):
                    continue
                order = np.argsort(h, kind="stable")
                at, h = at[order], h[order]
                heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                some, last = h[heads], at + m - 1
                found = np.empty((len(heads), 5), np.int64)
                found[:, 0] = np.diff(np.append(heads, len(h)))
                for c, (there, near) in ((1, (before[at], at - 1)), (3, (after[last], np.minimum(last + 1, n - 1)))):
                    found[:, c] = np.minimum.reduceat(np.where(there, side[near], -_MOST), heads)
                    found[:, c + 1] = np.maximum.reduceat(np.where(there, side[near], _MOST), heads)
                place = np.minimum(np.searchsorted(keys, some), max(len(keys) - 1, 0))
                old = keys[place] == some if len(keys) else np.zeros(len(some), bool)
                to, more = place[old], found[old]
                values[to, 0] += more[:, 0]
                values[to, 1::2] = np.minimum(values[to, 1::2], more[:, 1::2])
                values[to, 2::2] = np.maximum(values[to, 2::2], more[:, 2::2])
                fresh = np.flatnonzero(~old)
                names += [(langs[words.text[i]], m, words.spelled(i, m)) for i in at[heads[fresh]].tolist()]
                # names stay as they come; each row of values knows its own by its last column
                order = np.argsort(np.concatenate([keys, some[fresh]]), kind="stable")
                ids = np.arange(len(names) - len(fresh), len(names))
                own = np.concatenate([index, ids]) if len(keys) else ids
                keys = np.concatenate([keys, some[fresh]])[order]
                values = np.concatenate([values, found[fresh]])[order]
                index = own[order]
            if len(keys) > HELD_PHRASES:
                yield spelled(values, [names[i] for i in index])
                keys, values, names = empty[0], empty[1], []
        if len(keys):
            yield spelled(values, [names[i] for i in index])

    def spelled(values: np.ndarray, names: list[tuple[str, int, str]]) -> pa.RecordBatch:
        langs, sizes, phrases = zip(*names, strict=True)
        columns = [pa.array(langs), pa.array(sizes, pa.int32()), pa.array(phrases), *[pa.array(values[:, c].copy()) for c in range(5)]]
        return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in SPELLED.split(", ")])

    return run


def _summed(spelled: DataFrame) -> DataFrame:
    return spelled.groupBy("lang", "phrase").agg(
        F.first("m").alias("m"), F.sum("a").alias("a"),
        F.min("left_least").alias("left_least"), F.max("left_most").alias("left_most"),
        F.min("right_least").alias("right_least"), F.max("right_most").alias("right_most"),
    )


def _quotient(*factors: Column) -> Column:
    """``SCALE * a * n div (l * r)``, in decimals that hold all digits."""
    a, n, l, r = (c.cast("decimal(18,0)") for c in factors)  # noqa: E741
    return F.call_function("div", (F.lit(SCALE).cast("decimal(4,0)") * a * n).cast("decimal(38,0)"), (l * r).cast("decimal(38,0)"))


class Miner:
    """One run over ``docs`` (columns ``text``, ``lang``, ``tag``)."""

    def __init__(self, docs: DataFrame, least: int, top: int, first_part: float):
        self.docs, self.least, self.top = docs, least, top
        counted = docs.mapInArrow(_count_words, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
        counted = stash(counted.filter(F.col("word").isNull() | (F.col("f") >= least)), "words")
        self.totals = counted.filter("word is null").select("lang", F.col("f").alias("n"))
        words = hashed(counted.filter("word is not null").select("lang", F.col("word").alias("phrase"), "f"))
        words = words.join(self.totals, "lang").withColumn("bound", _quotient(F.lit(1), F.col("n"), F.col("f"), F.lit(1)))
        # words of about one frequency are one level; there are few levels, whatever the table
        self.words = stash(words.withColumn("level", F.floor(4 * F.log2("f"))), "words")
        levels = self.words.groupBy("lang", "n", "level").agg(F.sum("f").alias("f"))
        before = F.coalesce(F.sum("f").over(Window.partitionBy("lang").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        upto = levels.withColumn("before", before).filter(F.col("before") <= first_part * F.col("n"))
        self.upto = upto.groupBy("lang").agg(F.max("level").alias("upto"))
        self.frequent = Marks(self.words)

    def grow(self, opened: DataFrame) -> DataFrame:
        """Frequent phrases that begin with an opened word, counted by their letters."""
        first, known, wanted = Marks(opened), {}, {}
        for sizes in ([2], [3], [4, 5]):
            hashes = self.docs.mapInArrow(_count_hashes(first, self.frequent, dict(known), sizes), "m int, h long, a long")
            often = stash(hashes.groupBy("m", "h").agg(F.sum("a").alias("a")).filter(F.col("a") >= self.least).select("m", "h"), "hashes")
            for m in sizes:
                known[m] = wanted[m] = Marks(often.filter(F.col("m") == m))
        spelled = self.docs.mapInArrow(_count_spelled(wanted, self.frequent, first), SPELLED)
        out = stash(_summed(spelled).filter(F.col("a") >= self.least), "phrases")
        for marks in [first, *known.values()]:
            marks.drop()
        return out

    def rests(self, phrases: DataFrame, counted: DataFrame) -> DataFrame | None:
        """Counts of the rests of phrases that are not counted yet."""
        parts = F.split("phrase", " ")
        own = phrases.filter("m > 2").select("lang", F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - 2), lambda k: F.array_join(F.slice(parts, k + 1, 9), " "))).alias("phrase"))
        missing = stash(hashed(own.distinct().join(counted, ["lang", "phrase"], "left_anti").withColumn("m", F.size(F.split("phrase", " ")))), "rests")
        sizes = [r.m for r in missing.select("m").distinct().collect()]  # at most LONGEST - 2
        if not sizes:
            return None
        wanted = {m: Marks(missing.filter(F.col("m") == m)) for m in sizes}
        spelled = self.docs.mapInArrow(_count_spelled(wanted, self.frequent), SPELLED)
        out = stash(_summed(spelled).join(missing, ["lang", "phrase"], "left_semi").select("lang", "phrase", "a"), "rests")
        for marks in wanted.values():
            marks.drop()
        return out

    def scored(self, phrases: DataFrame, counted: DataFrame) -> DataFrame:
        """Surviving phrases with the lowest-scoring cut."""
        alone = (F.col("m") == LONGEST) | ((F.col("left_least") != F.col("left_most")) & (F.col("right_least") != F.col("right_most")))
        parts = F.split("phrase", " ")
        cuts = phrases.filter(alone).select(
            "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"), parts.alias("parts")
        ).select("lang", "phrase", "a", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("parts", F.col("k") + 1, F.lit(LONGEST)), " ").alias("rest"))
        both = cuts.join(counted.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
        both = both.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]).join(self.totals, "lang")
        score = _quotient(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
        best = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
        return best.select("lang", "phrase", "a", "n", "best.l", "best.r", "best.score")

    def first(self, scored: DataFrame) -> DataFrame:
        """The first ``top`` of each language, ranked."""
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.top)

    def run(self) -> DataFrame:
        counted = self.words.select("lang", "phrase", F.col("f").alias("a"))
        opened = self.words.join(self.upto, "lang").filter("level <= upto").drop("upto")
        phrases = done = None
        while True:
            grown = self.grow(opened)
            done = opened if done is None else done.unionByName(opened)
            # a bit set may have let words pass that are opened only now
            phrases = grown if phrases is None else stash(phrases.unionByName(grown).dropDuplicates(["lang", "phrase"]), "phrases")
            known = counted.unionByName(phrases.select("lang", "phrase", "a"))
            rests = self.rests(phrases, known)
            known = known if rests is None else known.unionByName(rests)
            scored = stash(self.scored(phrases, known), "scored")
            first = self.first(scored)
            last = first.groupBy("lang").agg(F.count("*").alias("found"), F.min("score").alias("least"))
            threshold = last.select("lang", F.when(F.col("found") == self.top, F.col("least")).otherwise(F.lit(0)).alias("threshold"))
            closed = self.words.join(done.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
            open_now = closed.join(threshold, "lang", "left").filter(F.col("bound") >= F.coalesce("threshold", F.lit(0)))
            opened = stash(open_now.select(self.words.columns), "opened")
            if opened.isEmpty():
                numbers = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
                return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *numbers)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, first_part: float = FIRST_PART) -> DataFrame:
    """The first ``top`` surviving phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    small_batches(docs.sparkSession)
    own = docs.select(text_of().alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    return Miner(own.withColumn("tag", F.xxhash64("lang")), least, top, first_part).run()


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER.decode()}', '{_LOWER.decode()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces
), sized AS (
  SELECT lang, w, unnest(range(1, {LONGEST + 1})) AS m FROM worded
), placed AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized WHERE len(w) >= m
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM placed) GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE m > 1 AND a >= {LEAST}
), surviving AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.m > c.m AND 100 * d.a >= 100 * c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), split AS (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM surviving
), cuts AS (
  SELECT s.lang, s.phrase, s.a, s.k, x.a AS l, y.a AS r, n.n, (1000::HUGEINT * s.a * n.n) // (x.a::HUGEINT * y.a) AS score
  FROM split s JOIN n ON n.lang = s.lang
  JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(s.w[1:s.k], ' ')
  JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(s.w[s.k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= {TOP}
"""
