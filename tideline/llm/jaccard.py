"""N-gram Jaccard join, size-aware: subsets for small sets, inverted lists for large ones.

A document's set is its distinct 5-word shingles. Two sets of sizes s and t link at a
similarity of 0.8 when they share ``need(s, t)`` shingles.

*Small sets* list, for every size t they can link with, all their subsets of ``need(s, t)``
shingles: sets with a subset in common are linked, without looking further. *Large sets* scan
inverted lists: shingles are ordered from rare to frequent, and linked sets must share one of
their first few. The boundary is the largest size whose subsets cost less than the lists and sets
they save (``boundary``). Sets just below it are in both parts, for links across it.

Frequent shingles are those that some batch of documents has several times; their order is by count,
all others by hash. The order decides cost only, never results.

Long lists do not become all pairs. Each set first tries only one of the list members that hold a list's
shingle earliest, the middle of a group of near copies: the nearest by sketch. Verified
links form components. Then every pair of a list that is in different components, and that
sizes, places in the lists and sketches do not rule out, is verified too, so no link between components
is lost; only such pairs leave the task that holds a list. A sketch gives a lower bound of the difference of two sets and rules out only what cannot link.

Equal sets are one class from the start (a 64-bit hash of the set), and copies cost
nothing. Verification compares whole sets.

Defined cases: null, empty and wordless texts have no shingles and link with nothing. Fewer than five words
are one shingle. Repeated rows are copies of one set. A null id is kept and gets the smallest other id
of its component, if any. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import IdFilter, byte_slices, parts, small_batches, stash, text_of
from tideline.llm.graph import components

WORDS = 5
POSTINGS_PER_PART = 500_000
#: A shingle is frequent if so many sets of one batch hold it; at most so many are ordered by count.
FREQUENT, MOST_FREQUENT = 5, 50_000
#: Bytes of text that are worked on together, a batch of documents.
TOGETHER = 4 << 20
#: In place of a place: a subset that links sets of one size, or of two sizes.
SAME, OTHER = -1, -2
#: Subsets may cost so many times what lists and sets do.
SUBSET_COST = 4
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_rng = np.random.default_rng(5)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def need(s: int, t: int) -> int:
    """Shingles that sets of sizes s and t must share: 100 * common >= 80 * union."""
    return -(-4 * (s + t) // 9)


def partners(s: int) -> range:
    """Sizes that a set of size s can link with."""
    return range(-(-4 * s // 5), 5 * s // 4 + 1)


def prefix(s):
    return s - -(-4 * s // 5) + 1


def boundary(cost: float = SUBSET_COST) -> int:
    """The largest small size: its subsets cost at most ``cost`` times its list entries and itself."""
    s = 1
    while sum(math.comb(s + 1, need(s + 1, t)) for t in partners(s + 1) if need(s + 1, t) <= s + 1) <= cost * (prefix(s + 1) + s + 1):
        s += 1
    return s


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * _K[0]
    h = (h ^ h >> np.uint64(29)) * _K[1]
    return h ^ h >> np.uint64(32)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(n, base)]).cumprod(dtype=np.uint64)


def shingle_sets(texts: list[bytes], chunk: int = 256 << 10) -> list[np.ndarray]:
    """The sorted 64-bit shingle hashes of each text."""
    out, start = [], 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= chunk):
            size += len(texts[end]) + 1
            end += 1
        out += _chunk_sets(texts[start:end])
        start = end
    return out


def _chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    inside = ~_SPACE[data]
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([[np.uint64(0)], (_BYTE[data] * _powers(_BASE, len(data))[:-1]).cumsum(dtype=np.uint64)])
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts]
    words = _mix(words + (ends - starts).astype(np.uint64) * _K[2])
    limits = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.searchsorted(starts, np.concatenate([[0], limits]))
    n = len(words) - WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(WORDS):
        rolled += words[k : k + max(n, 0)] * _K[k]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(firsts, firsts[1:], strict=False):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            out.append(_mix((words[a:b] * _K[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _class(s: np.ndarray) -> np.uint64:
    at = np.arange(len(s), dtype=np.uint64)
    return _mix(np.array([(_mix(s + at * _K[3]) * (at * _K[4] | np.uint64(1))).sum(dtype=np.uint64) + np.uint64(len(s))]))[0]


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def sketch(s: np.ndarray) -> bytes:
    """One bit per hash place: whether an odd number of shingles fall there; at least two places per shingle."""
    places = 1 << max(3, (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def distance(x: bytes, y: bytes) -> int:
    """At most the number of shingles that only one of two sets has."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):  # the larger folds onto itself
        if len(a) > len(b):
            a = a[: len(a) // 2] ^ a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches do not rule a link out."""
    for batch in batches:
        a, b, s, t, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "s", "t", "x", "y"))
        far = [distance(p, q) for p, q in zip(x, y, strict=True)]
        keep = np.array([d <= m + n - 2 * need(m, n) for d, m, n in zip(far, s, t, strict=True)], bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(a, np.int64)[keep]), pa.array(np.array(b, np.int64)[keep]), pa.array(np.array(far, np.int64)[keep])], ["a", "b", "far"]
        )


#: Bytes of the short sketch that goes with a list entry.
SHORT = 128
DESCRIBED = "kind int, id long, cls long, n long, sketch binary, short binary"


def folded(x: bytes, limit: int = SHORT) -> bytes:
    """A sketch of at most ``limit`` bytes."""
    a = np.frombuffer(x, np.uint8)
    while len(a) > limit:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return a.tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a document's id, class, size and sketch. Kind 1: a shingle that this batch often has, and its count."""
    for batch in (some for whole in batches for some in byte_slices(whole, TOGETHER)):
        sets = shingle_sets(_texts(batch, "text"))
        n = np.array([len(s) for s in sets], np.int64)
        classes = _signed([_class(s) if len(s) else 0 for s in sets])
        distinct = {c: s for c, s in zip(classes.tolist(), sets, strict=True)}
        held = np.concatenate(list(distinct.values()) or [np.empty(0, np.uint64)])
        held.sort()
        often = np.unique(held[FREQUENT - 1 :][held[FREQUENT - 1 :] == held[: max(0, len(held) - FREQUENT + 1)]])
        counts = np.searchsorted(held, often, "right") - np.searchsorted(held, often, "left")
        m = len(often)
        sketches = [sketch(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([0, 1], [len(sets), m]).astype(np.int32)),
            pa.chunked_array([batch.column("doc_id"), pa.array(_signed(often), pa.int64())]).combine_chunks(),
            pa.array(np.concatenate([classes, np.zeros(m, np.int64)]), mask=np.concatenate([n == 0, np.zeros(m, bool)])),
            pa.array(np.concatenate([n, counts])),
            pa.array(sketches + [None] * m, pa.binary()),
            pa.array([x and folded(x) for x in sketches] + [None] * m, pa.binary()),
        ], ["kind", "id", "cls", "n", "sketch", "short"])


def _postings(frequent: np.ndarray, rank: np.ndarray, small: int):
    """Entries of the inverted lists (place >= 0) and of the subset index (place SAME or OTHER)."""
    also = -(-4 * (small + 1) // 5)  # the smallest size that links with a large set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # of this task: a class is sent once
        for batch in (some for whole in batches for some in byte_slices(whole, TOGETHER)):
            keys, classes, sizes, places = [], [], [], []
            for s in shingle_sets(_texts(batch, "text")):
                n = len(s)
                if n == 0:
                    continue
                cls = _class(s)
                if cls in seen:
                    continue
                seen.add(cls)
                if n >= also:
                    order = s >> np.uint64(1)
                    if len(frequent):
                        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                        order = np.where(frequent[at] == s, rank[at] | np.uint64(1 << 63), order)
                    first = s[np.argsort(order, kind="stable")[: prefix(n)]]
                    keys.append(first)
                    places.append(np.arange(len(first)))
                if n <= small:
                    own = [
                        (hash((min(n, t), max(n, t), c)) & (2**64 - 1), SAME if n == t else OTHER)
                        for t in partners(n) if t <= small and need(n, t) <= n
                        for c in itertools.combinations(s.tolist(), need(n, t))
                    ]
                    keys.append(_mix(np.array([k for k, _ in own], np.uint64) ^ _K[4]))
                    places.append(np.array([p for _, p in own]))
                while len(classes) < len(keys):
                    m = len(keys[len(classes)])
                    classes.append(np.full(m, cls, np.uint64))
                    sizes.append(np.full(m, n))
            if keys:
                yield pa.RecordBatch.from_arrays([
                    pa.array(_signed(np.concatenate(keys))), pa.array(_signed(np.concatenate(classes))),
                    pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(places).astype(np.int32)),
                ], ["key", "cls", "size", "place"])

    return run


LISTED = "kind int, key long, cls long, other long, size int, place int"


def _columns(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    got = [[batch.column(n).to_numpy(zero_copy_only=False) for n in names] for batch in batches]
    return [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.empty(0, np.int64) for _ in names]


def _listed(kind: int, key, cls, other, size, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(key), kind, np.int32)), pa.array(key, pa.int64()), pa.array(cls, pa.int64()), pa.array(other, pa.int64()),
        pa.array(np.asarray(size, np.int32)), pa.array(np.asarray(place, np.int32)),
    ], ["kind", "key", "cls", "other", "size", "place"])


def _bound(s, i, t, j):
    """Can sets of sizes s and t link, whose first common list entries are at places i and j?"""
    return (np.minimum(s - i, t - j) >= -(-4 * (s + t) // 9)) & (5 * s >= 4 * t) & (5 * t >= 4 * s)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: entries of lists with two classes or more. Kind 1: votes for a list's middle, counted in
    ``place``. Kind 2: links by common subsets."""
    key, cls, size, place = _columns(batches, ["key", "cls", "size", "place"])
    spread = _signed(_mix(cls.view(np.uint64)))
    order = np.lexsort((cls, key))
    first = np.ones(len(order), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (cls[order][1:] != cls[order][:-1])
    order = order[first]
    again = key[order][1:] == key[order][:-1]
    shared = np.concatenate([again, [False]]) | np.concatenate([[False], again]) if len(order) else np.zeros(0, bool)
    order = order[shared]
    key, cls, size, place, spread = (x[order] for x in (key, cls, size, place, spread))
    large = place >= 0
    yield _listed(0, key[large], cls[large], cls[large], size[large], place[large])

    def heads(mask: np.ndarray, group: np.ndarray, by: tuple[np.ndarray, ...]):
        k, c, s, p, g = (x[mask] for x in (key, cls, size, place, group))
        at = np.lexsort((*[b[mask] for b in by], g, k))
        k, c, s, p, g = (x[at] for x in (k, c, s, p, g))
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
        return k, c, s, p, new

    if large.any():
        bins = np.floor(np.log(size) / math.log(1.25)).astype(np.int64)
        k, c, s, p, new = heads(large, bins, (spread, place))
        head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        fine = ~new & _bound(s.astype(np.int64), p, s[head].astype(np.int64), p[head])
        pairs, votes = np.unique(np.stack([c[fine], c[head][fine]], axis=1), axis=0, return_counts=True)
        yield _listed(1, np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1], np.zeros(len(pairs)), votes)
    if (~large).any():
        # sets of both sizes of a key link; the members of one size meet at a member of the other
        k, c, s, p, new = heads(~large, size.astype(np.int64) * 0, (spread, size))
        head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        last = len(k) - 1 - np.maximum.accumulate(np.where(np.concatenate([new[1:], [True]])[::-1], np.arange(len(k)), 0))[::-1]
        other = np.where(s == s[head], last, head)
        at = np.arange(len(k))
        same = s[head] == s[last]
        other = np.where(same, head, other)
        fine = (other != at) & ~(same & (p == OTHER))
        pairs = np.unique(np.stack([c[fine], c[other][fine]], axis=1), axis=0)
        yield _listed(2, np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1], np.zeros(len(pairs)), np.zeros(len(pairs)))


def _apart(sketches: list[bytes]) -> Callable[[int, np.ndarray], np.ndarray]:
    """A function that gives the least differences of one of the short sketches from others of up to twice its width."""
    width = np.array([max(1, len(x) // 8) for x in sketches])
    bits = np.zeros((len(sketches), 2 * max(width)), np.uint64)
    for i, x in enumerate(sketches):
        bits[i, : width[i]] = np.frombuffer(x.ljust(8, b"\0"), np.uint64)
    narrow = np.array([len(x) for x in sketches])

    def apart(i: int, js: np.ndarray) -> np.ndarray:
        n = width[i]
        same, twice = bits[js, :n], np.zeros((len(js), n), np.uint64)
        wide = width[js] == 2 * n
        twice[wide] = bits[js[wide], n : 2 * n]
        # below a word's width only sketches of one width are compared
        known = wide & (narrow[js] == 2 * narrow[i]) | (narrow[js] == narrow[i])
        return np.where(known, np.bitwise_count(bits[i, :n] ^ same ^ twice).sum(axis=1), 0)

    return apart


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a list that lie in different components and may link, by sizes, places and short sketches.

    So next to nothing but links is written, however long a list is.
    """
    batches = list(batches)
    key, cls, comp, size, place = _columns(batches, ["key", "cls", "comp", "size", "place"])
    sketches = [x for batch in batches for x in batch.column("short").to_pylist()]
    order = np.lexsort((size, key))
    key, cls, comp, size, place = (x[order].astype(np.int64) for x in (key, cls, comp, size, place))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.append(np.flatnonzero(new), len(key))
    found = np.empty((0, 2), np.int64)
    for a, b in zip(starts, starts[1:], strict=False):
        s, p = size[a:b], place[a:b]
        apart = _apart([sketches[i] for i in order[a:b]])
        for i in range(b - a - 1):  # sizes grow along the list
            to = np.searchsorted(s, 5 * s[i] // 4, "right")
            j = np.arange(i + 1, to)
            j = j[(comp[a + j] != comp[a + i]) & _bound(s[i], p[i], s[j], p[j])]
            if len(j):
                j = j[apart(i, j) <= s[i] + s[j] - 2 * -(-4 * (s[i] + s[j]) // 9)]
            if len(j):
                found = np.concatenate([found, np.stack([np.minimum(cls[a + j], cls[a + i]), np.maximum(cls[a + j], cls[a + i])], axis=1)])
        if len(found) > 200_000:
            found = np.unique(found, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
            found = found[:0]
    found = np.unique(found, axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _sets_of(docs: DataFrame, wanted_ids: DataFrame) -> DataFrame:
    """``cls`` and ``items`` of the documents whose id is wanted, through a filter of bounded size."""
    wanted = IdFilter(wanted_ids)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("p").to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array(wanted.holds(places)))
            seen, classes, items = set(), [], []
            for s in shingle_sets(_texts(some, "text")):
                if len(s) and (cls := _class(s)) not in seen:
                    seen.add(cls)
                    classes.append(cls)
                    items.append(_signed(s))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(classes), pa.int64()), pa.array(items, pa.list_(pa.int64()))], ["cls", "items"])

    chosen = docs.filter(F.col("doc_id").isNotNull()).select(IdFilter.place().alias("p"), "text")
    return chosen.mapInArrow(sets, "cls long, items array<long>")


def _filtered(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``far`` of the pairs that may link by their sketches."""
    left = sketches.select(F.col("cls").alias("a"), F.col("n").alias("s"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("cls").alias("b"), F.col("n").alias("t"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t", "x", "y").mapInArrow(_may_link, "a long, b long, far long")


def _verified(pairs: DataFrame, docs: DataFrame, one_id: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = stash(_sets_of(docs, one_id.join(ends, "cls").select("doc_id")).join(ends, "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(100 * common >= 80 * (F.size("x") + F.size("y") - common)).select("a", "b")


def with_class(docs: DataFrame, wanted: IdFilter) -> DataFrame:
    """The documents that ``wanted`` holds, with the class of the text's set in ``_class``, as ``linked_classes`` has it; null without words.

    Filter and classes share one Python worker per task: with one each, twice as many stay beside every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("_class").to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array(wanted.holds(places)))
            sets = shingle_sets([t or b"" for t in _texts(some, "text")])
            classes = pa.array([int(_signed(_class(s))) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], classes], batch.schema.names)

    placed = docs.filter(F.col("doc_id").isNotNull()).withColumn("_class", IdFilter.place())
    return placed.mapInArrow(run, placed.schema)


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document."""
    return linked_classes(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def linked_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``link_documents`` with ``cls``, which equal sets share."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    described = stash(docs.mapInArrow(_describe, DESCRIBED), "shingle-sets")
    own = described.filter("kind = 0").select(F.col("id").alias("doc_id"), "cls", F.col("n").alias("n_shingles"))
    often = described.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(MOST_FREQUENT).collect()
    frequent = np.array([r.id for r in often], np.int64).view(np.uint64)
    by = np.argsort(frequent)
    rank = np.array([r.n for r in often], np.uint64)[by]
    rank = (rank << np.uint64(24)) | np.arange(len(rank), dtype=np.uint64)
    total = own.agg(F.sum(F.expr("n_shingles - ceil(0.8 * n_shingles) + 1"))).first()[0] or 0
    n_parts = parts(int(total), POSTINGS_PER_PART)

    postings = docs.mapInArrow(_postings(frequent[by], rank, boundary()), "key long, cls long, size int, place int")
    listed = stash(postings.repartition(n_parts, "key").mapInArrow(_lists, LISTED), "lists")
    lists = listed.filter("kind = 0").select("key", "cls", "size", "place")
    sure = listed.filter("kind = 2").select(F.col("cls").alias("a"), F.col("other").alias("b")).distinct()
    in_lists = lists.select("cls").distinct()
    classes = described.filter("kind = 0 and cls is not null").join(in_lists, "cls", "left_semi")
    classes = stash(classes.groupBy("cls").agg(F.min("id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("short").alias("short")), "sketches")

    voted = listed.filter("kind = 1").select(F.col("cls").alias("a"), F.col("other").alias("b")).distinct()
    tried = _filtered(voted, classes).groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
    tried = stash(tried, "tried")
    near = stash(_verified(tried, docs, classes).union(sure), "near-links")
    labels = components(near)
    in_comps = lists.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    # only lists whose members are not all together by now are looked at again
    apart = in_comps.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).filter("first <> last").select("key")
    entries = in_comps.join(apart, "key", "left_semi").join(classes.select("cls", "short"), "cls").select("key", "cls", "comp", "size", "place", "short")
    several = entries.repartition(n_parts, "key").mapInArrow(_across, "a long, b long").distinct()
    rest = several.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    rest = stash(_filtered(rest, classes).select("a", "b"), "rest")
    far = stash(_verified(rest, docs, classes), "far-links")
    labels = components(near.union(far))

    grouped = own.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    smallest = grouped.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = grouped.join(smallest, "comp", "left")
    return out.select("doc_id", "cls", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
