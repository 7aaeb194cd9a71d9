"""Language-model scores of documents by a small causal self-attention model over subwords.

A text is the sequence of its words (A-Z lower-cased) and an end. Each word is spelled in subword ids. The model
gives the class of the next subword: one layer of causal self-attention with learned relative
positions, added to how often each class follows the last subword in all training text; within a class a subword
has its share of all training text. A word's probability is a fixed mixture of its spelling and
its share of the training words of texts of one kind; the ``KINDS`` kinds (clusters
by class counts, mostly languages) weigh by how well each explains the words so far.

* Counts (words, subwords, classes after subwords) come from every training document. Equal words are spelled once per batch.
* Classes come from what precedes each subword in all training text, kinds from the class shares of all training texts.
  Both are sums over all tasks; only the centres that kinds start from are chosen on ``STARTS`` texts.
* Attention weights are fitted in ``EPOCHS`` rounds. Training documents are dealt, by a hash of id and text, to units of about
  ``UNIT`` documents. In a round, the last round's weights are trained in numpy on each unit, in order of the hash, and the
  results are averaged, by how often a subword occurred or by the number of places. So scores don't depend on how
  the table is partitioned. Repeated rows whose subwords are more than ``LONGEST_UNIT`` make further units.
* The part of the word table in the mixture is fitted on all words of all training documents, by a histogram of
  how much more likely the table finds each word than its spelling does. A word that no other text has counts as unseen.
* Scoring cuts each document's subwords into overlapping windows of ``WINDOW`` places. Each window scores its last
  ``STRIDE`` places, so every subword is scored once, after at least ``WINDOW - STRIDE`` others where there are so many.
  Windows are batched; what lies before a text is masked.

The base score is the smoothed share of each word among all training words. The ``TABLE`` most frequent words, which would
make a join skewed, are in every task. The counts of all others are joined by hash with the distinct words of each block
of texts, and the block is scored with its own: what a word counts does not depend on ``TABLE``.

Defined cases: a null or empty text is one end. A null id counts as trained on if crc32 of nothing does (it is held out). Repeated
rows count and are scored each. With no training documents all words are unknown, and the score is the model's
before any fit. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import TEXTS_PER_BATCH, byte_slices, discard, parts, remainder, small_batches, stash, text_of
from tideline.llm.packing import encoder
from tideline.session import fresh_path

WINDOW, STRIDE = 24, 16
CLASSES, DIM = 48, 16
TABLE = 200_000
KINDS = 8
#: Part of a word's share over all kinds in its share of one kind.
BACK_OFF = 0.05
#: Texts among which the first centres of kinds are chosen.
STARTS = 2_000
EPOCHS, BATCH = 2, 256
#: Random marks by which subwords tell what they precede.
MARKS = 24
#: The histogram for the mixture: natural logarithms from -EDGE to EDGE.
EDGE, PER_UNIT = 64, 64
#: Bytes of text that are worked on together.
TOGETHER = 1 << 20
#: Rows of counts from which on they are summed and sent.
COUNTS_TOGETHER = 1 << 18
#: Training documents of a unit, on average.
UNIT = 2_048
#: Units and blocks are long rows: a file is cut so that few of them are written and read at once.
SMALL_GROUPS = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 2, "parquet.page.size.row.check.max": 1_000}
#: Subwords from which on a unit has no more texts.
LONGEST_UNIT = 4 << 20
PRIOR = 20.0
_BYTE = np.random.default_rng(8).integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The hash that stands for the end of a text among words.
END_WORD = np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ h >> np.uint64(32)


_power: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The powers 0 to ``n`` of the hash's base and of its inverse; few of them are kept."""
    kept = 1 << 18
    make = lambda n: [np.concatenate([[np.uint64(1)], np.full(n, b)]).cumprod(dtype=np.uint64) for b in (_BASE, _INVERSE)]
    if n > kept:
        return make(n)
    if not _power:
        _power.extend(make(kept))
    return [p[: n + 1] for p in _power]


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, a place of each, and which one each place has; not stable, which numpy sorts far faster."""
    order = np.argsort(hashes)
    own = hashes[order]
    new = np.append(True, own[1:] != own[:-1])[: len(own)]
    index = np.empty(len(own), np.int64)
    index[order] = np.cumsum(new) - 1
    return own[new], order[new], index


class Words:
    """The words of some texts: hashes, and spellings of the distinct ones."""

    def __init__(self, texts: list[bytes], spelled: bool = True):
        data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        edge = np.diff(np.concatenate([[False], ~_SPACE[data]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = np.empty(len(starts), np.uint64)
        for a in range(0, len(starts), 1 << 14):  # by stretches, which stay in the cache
            s, e = starts[a : a + (1 << 14)], ends[a : a + (1 << 14)]
            part = data[s[0] : e[-1]]
            up, down = _powers(len(part))
            sums = np.concatenate([[np.uint64(0)], (_BYTE[part] * up[:-1]).cumsum(dtype=np.uint64)])
            hashes[a : a + len(s)] = (sums[e - s[0]] - sums[s - s[0]]) * down[s - s[0]] + (e - s).astype(np.uint64)
        limits = np.cumsum([len(t) + 1 for t in texts])
        self.firsts = np.searchsorted(starts, np.concatenate([[0], limits]))  # of each text
        self.hashes, at, self.index = _distinct(_mix(hashes) | np.uint64(2))
        if spelled:
            self.spell(data, starts[at], ends[at])

    def spell(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """The subword ids of each distinct word after a space: ``flat`` from ``offset``, ``length`` many."""
        sizes = ends - starts
        at = np.repeat(starts - np.cumsum(sizes + 1) + sizes + 1, sizes + 1) + np.arange(int((sizes + 1).sum())) - 1
        joined = data[np.maximum(at, 0)].copy()
        joined[np.cumsum(sizes + 1) - sizes - 1] = 32
        enc = encoder()
        text = joined.tobytes().decode("utf-8", "replace")
        self.flat = enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32) if len(starts) else np.empty(0, np.int32)
        opens = _opens()[self.flat]
        if int(opens.sum()) != len(starts) or not (len(opens) == 0 or opens[0]):  # odd white space: word by word
            words = [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts, ends, strict=True)]
            each = [enc.encode_ordinary(" " + w) for w in words]
            self.flat = np.array([i for e in each for i in e], np.int32)
            self.length = np.array([len(e) for e in each], np.int64)
        else:
            self.length = np.diff(np.append(np.flatnonzero(opens), len(opens)))
        self.offset = np.cumsum(self.length) - self.length

    def sequence(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of word occurrences a to b, and how many each word has."""
        own = self.index[a:b]
        n = self.length[own]
        at = np.repeat(self.offset[own] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.flat[at], n


_opening: list[np.ndarray] = []


def _opens() -> np.ndarray:
    """Which subwords start with a space."""
    if not _opening:
        enc = encoder()
        _opening.append(np.array([enc.decode_single_token_bytes(i)[:1] == b" " for i in range(enc.n_vocab)]))
    return _opening[0]


def vocabulary() -> tuple[int, int, int, int]:
    """Ids of the end, the beginning and what lies before it, and how many there are."""
    n = encoder().n_vocab
    return n, n + 1, n + 2, n + 3


_marked: list[np.ndarray] = []


def _marks() -> np.ndarray:
    """The marks of each subword, by mark."""
    if not _marked:
        _marked.append(np.round(np.random.default_rng(3).standard_normal((vocabulary()[3], MARKS)) * 256).astype(np.int16).T.copy())
    return _marked[0]


def contexts(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How often each subword occurs, and the sums of the marks of what precedes it; whole numbers, exact in any order."""
    end, begin, _, size = vocabulary()
    sums = np.zeros((size, MARKS), np.int64)
    if not sequences:
        return np.zeros(size, np.int64), sums
    marks = _marks()
    stream = np.concatenate([np.concatenate([[begin], s, [end]]) for s in sequences])
    before, after = stream[:-1], stream[1:]
    inside = after < end
    pairs = np.sort(after[inside].astype(np.int64) << 32 | before[inside])
    at = np.flatnonzero(np.diff(pairs, prepend=-1))
    times = np.diff(np.append(at, len(pairs)))
    after, before = pairs[at] >> 32, pairs[at] & 0xFFFFFFFF
    for k in range(MARKS):
        sums[:, k] = np.bincount(after, marks[k][before] * times, size)
    return np.bincount(after, times, size).astype(np.int64), sums


def cluster(sequences: list[np.ndarray]) -> np.ndarray:
    return classes_of(*contexts(sequences))


def classes_of(all_counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A class for each subword, by what precedes it; the end is alone in the last class."""
    end, _, _, size = vocabulary()
    classes = np.full(size, CLASSES - 2, np.int32)  # what no text has
    classes[end:] = CLASSES - 1
    seen = np.flatnonzero(all_counts)
    if not len(seen):
        return classes
    counts = all_counts[seen]
    around = sums[seen] / 256 / np.sqrt(counts)[:, None]
    around /= np.maximum(np.linalg.norm(around, axis=1, keepdims=True), 1e-9)
    points = np.column_stack([around, np.where(_opens()[seen], 1.5, 0.0)])
    n = min(CLASSES - 2, len(seen))
    heavy = np.argsort(-counts, kind="stable")[: max(n, 3000)]
    centres = points[heavy[:n]].copy()
    weight = np.sqrt(counts[heavy])
    for _ in range(15):
        own = ((centres**2).sum(axis=1) - 2 * points[heavy] @ centres.T).argmin(axis=1)
        for c in range(n):
            if (own == c).any():
                centres[c] = np.average(points[heavy][own == c], axis=0, weights=weight[own == c])
    classes[seen] = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
    return classes


def histograms(sequences: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    """The root of each class's share, text by text."""
    out = np.zeros((len(sequences), CLASSES))
    for k, ids in enumerate(sequences):
        out[k] = np.bincount(classes[ids], minlength=CLASSES)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def first_kinds(points: np.ndarray) -> np.ndarray:
    """The centres that kinds start from, far from each other."""
    if not len(points):
        return np.zeros((KINDS, CLASSES))
    centres = points[:1]
    for _ in range(KINDS - 1):
        far = ((points[:, None] - centres) ** 2).sum(axis=2).min(axis=1)
        centres = np.concatenate([centres, points[[int(np.argsort(far)[-max(1, len(far) // 50)])]]])
    return centres


def kinds_of(shares: DataFrame) -> np.ndarray:
    """Centres of kinds of texts, by k-means over all of them; ``shares`` has a histogram in ``h`` per text."""
    some = shares.orderBy(F.xxhash64("h"), "h").limit(STARTS).toPandas()["h"]
    centres = first_kinds(_points(some))
    if not len(some):
        return centres
    for _ in range(15):
        sums = shares.mapInArrow(_kind_sums(centres), "kind int, place int, total long").groupBy("kind", "place").agg(F.sum("total").alias("total"))
        sums = sums.toPandas()  # KINDS * (CLASSES + 1) rows
        own = np.zeros((KINDS, CLASSES + 1))
        own[sums["kind"], sums["place"]] = sums["total"]
        full = own[:, CLASSES] > 0
        moved = np.where(full[:, None], own[:, :CLASSES] / 65535 / np.maximum(own[:, CLASSES:], 1), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _points(h) -> np.ndarray:
    return np.frombuffer(b"".join(h), np.uint16).reshape(-1, CLASSES) / 65535


def _kind_sums(centres: np.ndarray):
    """Sums of the histograms of each kind's texts, and at the last place how many they are; whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((KINDS, CLASSES + 1), np.int64)
        for batch in batches:
            points = _points(batch.column("h").to_pylist())
            own = nearest_kind(points, centres)
            for k in range(KINDS):
                total[k, :CLASSES] += np.round(points[own == k] * 65535).astype(np.int64).sum(axis=0)
                total[k, CLASSES] += (own == k).sum()
        kind, place = np.divmod(np.arange(total.size), CLASSES + 1)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total.ravel())], ["kind", "place", "total"])

    return run


def nearest_kind(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Table:
    """Some words: counts, and shares per kind of text."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, by_kind: np.ndarray, kind_totals: np.ndarray, total: int):
        order = np.argsort(words)
        self.words, self.counts, self.total = words[order], counts[order], max(total, 1)
        usual = self.counts[:, None] / self.total
        own = by_kind[order] / np.maximum(kind_totals, 1)
        self.shares = np.where(kind_totals > 0, (1 - BACK_OFF) * own + BACK_OFF * usual, usual)
        # the last row is for words that are not here: they tell nothing of the kind
        self.shares = np.concatenate([self.shares, np.zeros((1, KINDS))]).astype(np.float32)
        self.logs = np.log(np.where(self.shares > 0, self.shares, 1)).astype(np.float32)
        self.prior = np.log((kind_totals + 1) / (kind_totals.sum() + KINDS))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of words; the last one for what is not here."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words))

    def count(self, rows: np.ndarray) -> np.ndarray:
        return np.append(self.counts, 0)[rows]

    def only(self, hashes: np.ndarray, more: Table) -> Table:
        """A table whose rows are these words, taken from this one or else from ``more``."""
        part = copy.copy(self)
        at, other = self.find(hashes), more.find(hashes)
        here = (at < len(self.words))[:, None]
        part.words, part.counts = hashes, np.where(here[:, 0], self.count(at), more.count(other))
        part.shares, part.logs = np.where(here, self.shares[at], more.shares[other]), np.where(here, self.logs[at], more.logs[other])
        return part

    def probabilities(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each word of some texts, ``sizes`` words each, given the words before it in its text."""
        out = np.empty(len(rows))
        start = 0
        for a in range(0, len(sizes), 256):
            n = sizes[a : a + 256]
            some = rows[start : start + int(n.sum())]
            logs = self.logs[some].astype(np.float64)
            past = np.cumsum(logs, axis=0) - logs
            past -= np.repeat(past[np.cumsum(n) - n], n, axis=0)
            past += self.prior
            past -= past.max(axis=1, keepdims=True)
            np.exp(past, out=past)
            out[start : start + len(some)] = (past * self.shares[some]).sum(axis=1) / past.sum(axis=1)
            start += len(some)
        return out


#: Row sums are products with these, which is faster than to add along short rows.
_ONES = np.ones(max(WINDOW, CLASSES), np.float32)


def _plain(total: np.ndarray) -> bool:
    """Whether sums of exponentials are far from what float32 can't hold, so that no maximum has to be taken off."""
    return bool(len(total) == 0 or 1e-20 < total.min() <= total.max() < 1e30)


def sums_of(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, in order, and the sum of the rows of each."""
    keys = ids.astype(np.int64) << 32 | np.arange(len(ids))
    keys.sort()
    ids, by_id = keys >> 32, keys & 0xFFFFFFFF
    cuts = np.flatnonzero(np.diff(ids, prepend=-1))
    # two floats are added as one complex number, as each row has its price
    return ids[cuts], np.add.reduceat(rows.take(by_id, axis=0).view(np.complex64), cuts, axis=0).view(np.float32)


class Attention:
    """Weights of the layer, its forward pass and its training."""

    def __init__(self, follows: np.ndarray, within: np.ndarray, classes: np.ndarray):
        self.follows, self.within, self.classes = follows, within, classes  # log shares: class after id; id in class
        size = len(classes)
        rng = np.random.default_rng(1)
        self.embed = (rng.standard_normal((size, DIM)) * 0.3).astype(np.float32)
        self.embed[vocabulary()[2]] = 0  # so that it adds nothing to any sum, and is never moved
        self.wq, self.wk = ((rng.standard_normal((DIM, DIM)) / math.sqrt(DIM)).astype(np.float32) for _ in range(2))
        self.wv = np.zeros((DIM, CLASSES), np.float32)
        self.place = np.zeros(WINDOW, np.float32)
        at = np.arange(WINDOW)
        self.back = at[WINDOW - STRIDE :, None] - at[None, :]
        self.causal = np.where(self.back >= 0, 0, -1e9).astype(np.float32)
        self.frozen: np.ndarray | None = None

    def freeze(self) -> Attention:
        """A table of what each subword asks of others, so that scoring only looks it up."""
        self.frozen = self.embed @ (self.wq / np.float32(math.sqrt(DIM))) @ self.wk.T
        return self

    def attend(self, asked: np.ndarray, turned: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How much each of the last STRIDE places takes of each place; ``turned`` has the places' subwords as columns."""
        p = asked @ turned
        padded = x == vocabulary()[2]
        some = np.flatnonzero(padded.any(axis=1))
        with np.errstate(over="ignore", invalid="ignore"):
            np.exp(p, out=p)
            p *= np.where(self.back >= 0, np.exp(self.place[np.maximum(self.back, 0)]), np.float32(0))
            p[some] *= ~padded[some, None]
            total = p.reshape(-1, WINDOW) @ _ONES[:WINDOW]
        if not _plain(total):
            p = asked @ turned + self.causal + self.place[np.maximum(self.back, 0)] + np.where(padded, np.float32(-1e9), np.float32(0))[:, None]
            p -= p.max(axis=2, keepdims=True)
            np.exp(p, out=p)
            total = p.sum(axis=2)
        p *= (1 / total).reshape(len(x), STRIDE, 1)
        return p

    def exponentials(self, taken: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | int]:
        """Of every class, up to a factor a row, their sums, and the logarithm of that factor with its sign changed."""
        z = taken @ self.wv
        z += self.follows.take(last, axis=0)
        with np.errstate(over="ignore", invalid="ignore"):
            np.exp(z, out=z)
            total = z @ _ONES[:CLASSES]
        if _plain(total):
            return z, total, 0
        z = taken @ self.wv + self.follows.take(last, axis=0)
        top = z.max(axis=1)
        np.exp(z - top[:, None], out=z)
        return z, z.sum(axis=1), top

    def log_shares(self, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of the ids ``target`` after the last STRIDE places of windows ``x``."""
        e = self.embed.take(x, axis=0)
        last = x[:, WINDOW - STRIDE :].ravel()
        p = self.attend(self.frozen.take(last, axis=0).reshape(-1, STRIDE, DIM), e.transpose(0, 2, 1).copy(), x)
        taken = (p @ e).reshape(-1, DIM)
        z, total, top = self.exponentials(taken, last)
        own = self.classes.take(target.ravel())
        # the class's own exponent, as its exponential may be 0
        logit = np.einsum("ij,ij->i", taken, self.wv.T.take(own, axis=0)) + self.follows.ravel().take(last * np.int64(CLASSES) + own)
        return (logit - top - np.log(total)).reshape(target.shape) + self.within.take(target)

    def train(self, x: np.ndarray, target: np.ndarray) -> None:
        """``EPOCHS`` passes over windows."""
        self.begin()
        for _ in range(EPOCHS):
            self.learn(x, target)

    def begin(self) -> None:
        weights = self.weights()
        self.moments = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        self.order, self.steps = np.random.default_rng(2), 0

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.wq, self.wk, self.wv, self.place]

    def learn(self, x: np.ndarray, target: np.ndarray, rate: float = 0.01) -> None:
        """Adam on the cross entropy of the next class, by hand-written gradients. A step moves the subwords that it has."""
        weights = self.weights()
        first, second = self.moments
        order = self.order.permutation(len(x))
        front, root = WINDOW - STRIDE, np.float32(1 / math.sqrt(DIM))
        by_window = lambda t: t.reshape(-1, STRIDE, DIM)
        for a in range(0, len(order), BATCH):
            some, goal = x[order[a : a + BATCH]], target[order[a : a + BATCH]].ravel()
            last, real = some[:, front:].ravel(), goal >= 0
            part = real / np.float32(max(int(real.sum()), 1))
            e = self.embed.take(some, axis=0)
            turned, el = e.transpose(0, 2, 1).copy(), e[:, front:].reshape(-1, DIM)
            q = el @ (self.wq * root)
            asked = q @ self.wk.T
            p = self.attend(by_window(asked), turned, some)
            taken = (p @ e).reshape(-1, DIM)
            z, total, _ = self.exponentials(taken, last)
            z *= (part / total)[:, None]
            z.ravel()[np.arange(0, z.size, CLASSES) + self.classes.take(np.maximum(goal, 0))] -= part
            # from here on, what the loss changes by
            d_taken = z @ self.wv.T
            ds = by_window(d_taken) @ turned
            ds -= np.einsum("ij,ij->i", d_taken, taken).reshape(-1, STRIDE, 1)
            ds *= p
            d_asked = (ds @ e).reshape(-1, DIM)
            dq = d_asked @ self.wk
            de = ds.transpose(0, 2, 1) @ by_window(asked)
            de += p.transpose(0, 2, 1) @ by_window(d_taken)
            de[:, front:] += by_window(dq @ (self.wq.T * root))
            by_place = np.ones(len(ds), np.float32) @ ds.reshape(len(ds), -1)
            grad_place = np.bincount(np.maximum(self.back, 0).ravel(), np.where(self.back.ravel() >= 0, by_place, 0), WINDOW).astype(np.float32)
            here, grad_embed = sums_of(some.ravel(), de.reshape(-1, DIM))
            grads = [grad_embed, el.T @ dq * root, d_asked.T @ q, taken.T @ z, grad_place]
            self.steps += 1
            for i, (w, g) in enumerate(zip(weights, grads, strict=True)):
                at = here if i == 0 else slice(None)
                m, v = first[i][at], second[i][at]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                first[i][at], second[i][at] = m, v
                w[at] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)

    def small(self) -> np.ndarray:
        """All weights but the subwords' own, as rows of ``DIM`` numbers."""
        every = np.concatenate([w.ravel() for w in self.weights()[1:]])
        return np.append(every, np.zeros(-len(every) % DIM, np.float32)).reshape(-1, DIM)

    def take(self, rows: np.ndarray, values: np.ndarray) -> None:
        """Sets weights by row: a subword's own, then the rows of ``small``."""
        size = len(self.embed)
        self.embed[rows[rows < size]] = values[rows < size]
        rest = self.small()
        rest[rows[rows >= size] - size] = values[rows >= size]
        rest, at = rest.ravel(), 0
        for w in self.weights()[1:]:
            w[...] = rest[at : at + w.size].reshape(w.shape)
            at += w.size


def windows(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts, their targets (-1: none), and each text's number of targets."""
    end, begin, pad, _ = vocabulary()
    sizes = np.array([len(s) + 1 for s in sequences], np.int64)
    counts = -(-sizes // STRIDE)
    front = WINDOW - STRIDE
    whole = front + counts * STRIDE
    base = np.cumsum(whole) - whole
    stream = np.full(int(whole.sum()) + 1, pad, np.int32)
    goal = np.full(int(whole.sum()) + 1, -1, np.int32)
    for s, b in zip(sequences, base, strict=True):
        at = b + front
        stream[at] = begin
        stream[at + 1 : at + 1 + len(s)] = s
        goal[at : at + len(s)] = s
        goal[at + len(s)] = end
    starts = np.repeat(base - (np.cumsum(counts) - counts) * STRIDE, counts) + np.arange(int(counts.sum())) * STRIDE
    x = stream[starts[:, None] + np.arange(WINDOW)]
    target = goal[starts[:, None] + np.arange(front, WINDOW)]
    return x, target, sizes


def log_probabilities(model: Attention, sequences: list[np.ndarray]) -> np.ndarray:
    """Of each subword and each text's end, text after text."""
    x, target, _ = windows(sequences)
    out = np.empty(target.shape, np.float32)
    for a in range(0, len(x), BATCH):  # few, so that they stay in the cache
        out[a : a + BATCH] = model.log_shares(x[a : a + BATCH], np.maximum(target[a : a + BATCH], 0))
    return out[target >= 0]


KIND_COUNTS = [f"k{k}" for k in range(KINDS)]
COUNTED = "kind int, a long, b long, n long"


def _tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers from 0 on and how often each occurs."""
    values = np.sort(values)
    at = np.flatnonzero(np.diff(values, prepend=-1))
    return values[at], np.diff(np.append(at, len(values)))


def _count(classes: np.ndarray, centres: np.ndarray):
    """Kind 0: a word's hash and the kind of text; kind 1: a subword's id; kind 2: a subword's id and the class after it."""
    end, begin, _, _ = vocabulary()

    def tallies(texts: list[bytes]) -> list[np.ndarray]:
        words = Words(texts)
        kind_of = nearest_kind(histograms(_sequences(words), classes), centres)
        used, times = _tally(words.index * KINDS + np.repeat(kind_of, np.diff(words.firsts)))
        ids, _ = words.sequence(0, len(words.index))
        ends = np.concatenate([[0], np.cumsum(words.length[words.index])])[words.firsts]
        with_ends = np.insert(ids, ends[1:], end)
        follow = np.concatenate([[begin], with_ends[:-1]])
        follow[follow == end] = begin
        pairs, pair_n = _tally(follow.astype(np.int64) * CLASSES + classes[with_ends])
        some, some_n = _tally(with_ends)
        rows = [
            (0, np.append(words.hashes[used // KINDS], np.full(KINDS, END_WORD)).view(np.int64), np.append(used % KINDS, np.arange(KINDS)),
             np.append(times, np.bincount(kind_of, minlength=KINDS))),
            (1, some, np.zeros(len(some)), some_n),
            (2, pairs // CLASSES, pairs % CLASSES, pair_n),
        ]
        return [np.concatenate([np.asarray(c[k], np.int64) for c in rows]) for k in (1, 2, 3)] + [np.repeat([0, 1, 2], [len(r[1]) for r in rows])]

    def summed(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        a, b, n, kind = (np.concatenate(c) for c in zip(*found, strict=True))
        # equal rows come together; others between them would only be sent apart, as the sums are added again
        order = np.argsort(_mix(a.view(np.uint64) + (kind * CLASSES + b).view(np.uint64) * _BASE))
        a, b, n, kind = a[order], b[order], n[order], kind[order]
        at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (kind[1:] != kind[:-1])]))
        return pa.RecordBatch.from_arrays(
            [pa.array(kind[at].astype(np.int32)), pa.array(a[at]), pa.array(b[at]), pa.array(np.add.reduceat(n, at))], ["kind", "a", "b", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for some in (part for batch in batches for part in byte_slices(batch, TOGETHER)):
            found.append(tallies(some.column("text").cast(pa.binary()).to_pylist()))
            size += len(found[-1][0])
            if size > COUNTS_TOGETHER:
                yield summed(found)
                found, size = [], 0
        if found:
            yield summed(found)

    return run


def _sequences(words: Words) -> list[np.ndarray]:
    return [words.sequence(a, b)[0] for a, b in zip(words.firsts, words.firsts[1:], strict=False)]


def _id_type() -> type:
    return np.uint16 if vocabulary()[3] <= 1 << 16 else np.int32


def _units(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The texts of each unit."""
    for unit in column:
        numbers = np.frombuffer(unit.as_buffer(), np.int32, 1)
        at = np.cumsum(np.append(0, np.frombuffer(unit.as_buffer(), np.int32, numbers[0], 4)))
        values = np.frombuffer(unit.as_buffer(), _id_type(), at[-1], 4 + 4 * int(numbers[0])).astype(np.int32)
        yield [values[a:b] for a, b in zip(at, at[1:], strict=False)]


def _unit_row(sequences: list[np.ndarray]) -> pa.Array:
    """One unit: how many texts, how long they are, their subword ids. Spark has far less to hold so than of nested lists."""
    sizes = np.array([len(sequences), *map(len, sequences)], np.int32)
    return pa.array([sizes.tobytes() + np.concatenate(sequences).astype(_id_type()).tobytes()], pa.binary())


SUMS = [f"s{k}" for k in range(MARKS)]
CONTEXTS = f"a long, n long, {', '.join(c + ' long' for c in SUMS)}, ids binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted by unit give a row with ``ids`` for each unit, and at the end a row without for each subword."""
    counts, sums = contexts([])
    whole = lambda v: pa.array(v, pa.int64())
    names = ["a", "n", *SUMS, "ids"]
    held: list[np.ndarray] = []
    unit, size = None, 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * (MARKS + 2) + [_unit_row(held)], names)

    for batch in batches:
        for some in byte_slices(batch, TOGETHER):
            sequences = _sequences(Words(some.column("text").cast(pa.binary()).to_pylist()))
            n, s = contexts(sequences)
            counts += n
            sums += s
            for own, sequence in zip(some.column("unit").to_pylist(), sequences, strict=True):
                if held and (own != unit or size > LONGEST_UNIT):
                    yield row()
                    held, size = [], 0
                held.append(sequence)
                unit, size = own, size + len(sequence)
    if held:
        yield row()
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([whole(seen), whole(counts[seen]), *(whole(c) for c in sums[seen].T), pa.nulls(len(seen), pa.binary())], names)


def _histograms(classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sequences in _units(batch.column("ids")):
                h = np.round(histograms(sequences, classes) * 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in h], pa.binary())], ["h"])

    return run


WEIGHTS = [f"w{k}" for k in range(DIM)]


def _round(shared: Broadcast[Attention]):
    """The weights after training on a unit, times what they count: ``n``; summed over a task's units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = copy.copy(shared.value)
        model.embed, model.wq, model.wk, model.wv, model.place = (w.copy() for w in model.weights())  # other tasks of the process start from the same
        size = len(model.embed)
        rest = size + np.arange(len(model.small()))
        before = np.concatenate([model.embed, model.small()])
        total, n = np.zeros(before.shape), np.zeros(len(before), np.int64)
        for batch in batches:
            for sequences in _units(batch.column("ids")):
                model.take(np.arange(len(before)), before)
                model.begin()
                x, target, _ = windows(sequences)
                model.learn(x, target)
                seen = np.bincount(x.ravel(), minlength=size)
                rows = np.flatnonzero(seen)
                total[rows] += model.embed[rows] * seen[rows, None].astype(np.float64)
                places = int((target >= 0).sum())
                total[rest] += model.small() * float(places)
                n[rows] += seen[rows]
                n[rest] += places
        rows = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(n[rows]), *(pa.array(c) for c in total[rows].T)], ["a", "n", *WEIGHTS])

    return run


def train(model: Attention, training: DataFrame) -> None:
    """``EPOCHS`` rounds over all training documents."""
    for _ in range(EPOCHS):
        schema = f"a long, n long, {', '.join(c + ' double' for c in WEIGHTS)}"
        shared = training.sparkSession.sparkContext.broadcast(model)
        sums = training.mapInArrow(_round(shared), schema).groupBy("a").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in WEIGHTS])
        sums = sums.toPandas()  # a row per subword at most, and those of small()
        shared.destroy()  # else its copies on disk stay until the driver collects its garbage
        if not len(sums):
            return
        model.take(sums["a"].to_numpy(np.int64), sums[WEIGHTS].to_numpy(np.float64).reshape(-1, DIM) / sums[["n"]].to_numpy(np.float64))


BLOCKS = "block long, data binary, word long"
TEXTS = ["doc_id", "held_out", "text"]


def _packed(batch: pa.RecordBatch) -> bytes:
    """A block's documents as one compressed value, as all of them are written and shuffled."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _blocks(frequent: np.ndarray):
    """A row with ``data`` has the documents of a block; the others are a block's distinct words outside ``frequent``, which is sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        for big in batches:
            for batch in byte_slices(big, TOGETHER):
                own = np.append(Words(batch.column("text").cast(pa.binary()).to_pylist(), spelled=False).hashes, END_WORD)
                own = np.setdiff1d(own, frequent, assume_unique=True).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(1 + len(own), block)),
                    pa.concat_arrays([pa.array([_packed(batch.select(TEXTS))], pa.binary()), pa.nulls(len(own), pa.binary())]),
                    pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(own)]),
                ], ["block", "data", "word"])
                block += 1

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, spelled double, ratios array<float>, bin int, n long"


def _score(shared: Broadcast[tuple[Attention, Table]], kind_totals: np.ndarray, train_tokens: int, distinct: int):
    """The documents of a block, with the counts of its words outside the table. ``spelled`` is the log of all spellings, ``ratios`` have
    the log of share by spelling for each word and the end. Rows with a ``bin`` count the ratios of training documents."""
    scale = math.log10(train_tokens + 0.1 * (distinct + 1)) if train_tokens else -1.0
    names = [c.split()[0] for c in SCORED.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float32()), pa.int32(), pa.int64()]

    def rows_of(**columns: pa.Array) -> pa.Table:
        m = len(next(iter(columns.values())))
        return pa.Table.from_arrays([columns[c].cast(t) if c in columns else pa.nulls(m, t) for c, t in zip(names, types, strict=True)], names)

    def run(packed: pa.Table, others: pa.Table) -> pa.Table:
        model, table = shared.value
        if model.frozen is None:  # once per process, as it would add to what is sent
            model.freeze()
        if not packed.num_rows:
            return rows_of(bin=pa.array([], pa.int32()))
        block = pa.ipc.open_stream(packed.column("data")[0].as_buffer()).read_all()  # a block has one row
        words = Words(block.column("text").cast(pa.binary()).to_pylist())
        sequences = _sequences(words)
        rest = others.select(["word", "c", *KIND_COUNTS]).to_pandas()
        rest = Table(rest["word"].to_numpy(np.int64).view(np.uint64), rest["c"].to_numpy(np.int64), rest[KIND_COUNTS].to_numpy(np.float64).reshape(-1, KINDS), kind_totals, train_tokens)
        own = table.only(np.append(words.hashes, END_WORD), rest)
        counts, end_count = own.counts[:-1], int(own.counts[-1])
        logs = log_probabilities(model, sequences).astype(np.float64)
        n_words = np.diff(words.firsts)
        text = np.repeat(np.arange(len(sequences)), n_words)
        # a text's words, then its end
        lengths = np.insert(words.length[words.index], words.firsts[1:], 1)
        spelled = np.add.reduceat(logs, np.cumsum(lengths) - lengths)
        with_ends = np.insert(words.index, words.firsts[1:], len(words.hashes))
        with np.errstate(divide="ignore"):
            ratios = np.log(own.probabilities(with_ends, n_words + 1)) - spelled
        starts = words.firsts[:-1] + np.arange(len(sequences))
        # a text's own words must not speak for their shares
        _, inside, times = np.unique(text * len(words.hashes) + words.index, return_inverse=True, return_counts=True)
        only_here = np.insert(counts[words.index] <= times[inside], words.firsts[1:], False)
        used = np.where(only_here, -np.inf, ratios)[np.repeat(~block.column("held_out").to_numpy(), n_words + 1)]
        bins = np.bincount(((np.clip(used, -EDGE, EDGE - 1e-6) + EDGE) * PER_UNIT).astype(np.int64))
        known = counts[words.index]
        part = np.where(known > 0, np.log10(known + 0.1), -1.0) - scale
        filled = np.flatnonzero(bins)
        return pa.concat_tables([
            rows_of(
                doc_id=block.column("doc_id"), held_out=block.column("held_out"), n_tokens=pa.array(n_words + 1),
                n_known=pa.array(np.bincount(text, known > 0, len(sequences)).astype(np.int64) + (end_count > 0)),
                base=pa.array(np.bincount(text, part, len(sequences)) + (math.log10(end_count + 0.1) - scale)),
                spelled=pa.array(np.add.reduceat(spelled, starts)),
                ratios=pa.ListArray.from_arrays(pa.array(np.append(starts, len(ratios)).astype(np.int32)), pa.array(ratios.astype(np.float32))),
            ),
            rows_of(bin=pa.array(filled), n=pa.array(bins[filled])),
        ])

    return run


def gather(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each subword occurs, and each class after each subword: a row per subword at most."""
    size = vocabulary()[3]
    own, follows = np.zeros(size), np.zeros((size, CLASSES))
    for r in counted.filter("kind = 1").select("a", "n").collect():
        own[r.a] = r.n
    pairs = counted.filter("kind = 2").groupBy("a").agg(F.collect_list(F.struct("b", "n")).alias("l"))
    for r in pairs.toLocalIterator():
        for b, n in r.l:
            follows[r.a, b] = n
    return own, follows


def start(own: np.ndarray, follows: np.ndarray, classes: np.ndarray) -> Attention:
    """The model from the counts of all training text, before its weights are trained."""
    own = own + 0.5
    per_class = np.bincount(classes, own, CLASSES)
    within = np.log(own / per_class[classes])
    usual = (per_class + 1e-3) / (per_class + 1e-3).sum()
    follows = np.log((follows + PRIOR * usual) / (follows.sum(axis=1, keepdims=True) + PRIOR))
    return Attention(follows.astype(np.float32), within.astype(np.float32), classes)


def fit(own: np.ndarray, follows: np.ndarray, texts: list[bytes], classes: np.ndarray) -> Attention:
    """The model from counts and texts, in this process."""
    model = start(own, follows, classes)
    if texts:
        x, target, _ = windows(_sequences(Words(texts)))
        model.train(x, target)
    return model.freeze()


def mixture(bins: np.ndarray, counts: np.ndarray) -> float:
    """The part of the word table in the mixture, by expectation maximisation on the ratios of share and spelling."""
    if not counts.sum():
        return 0.0
    ratio = np.exp((bins + 0.5) / PER_UNIT - EDGE)
    mixed = 0.5
    for _ in range(20):
        mixed = float(np.average(mixed * ratio / (mixed * ratio + 1 - mixed), weights=counts))
    return min(max(mixed, 0.01), 0.99)


def _mixed(part: float):
    """Scores from the spellings and the ratios."""
    with np.errstate(divide="ignore"):
        table, spelling = np.log(part), np.log(1 - part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, TEXTS_PER_BATCH) for whole in batches for a in range(0, whole.num_rows, TEXTS_PER_BATCH)):
            ratios = batch.column("ratios")
            n = ratios.value_lengths().to_numpy(zero_copy_only=False)
            value = np.logaddexp(spelling, table + ratios.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            score = (batch.column("spelled").to_numpy() + np.add.reduceat(value, np.cumsum(n) - n)) / math.log(10) if len(n) else np.zeros(0)
            kept = [c for c in batch.schema.names if c not in ("spelled", "ratios")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score)], [*kept, "score"])

    return run


def _least_count(word_counts: DataFrame) -> int:
    """The count from which on words are in the table, so that TABLE of them are at most."""
    step = F.floor(F.log2("c") * 16).cast("int").alias("step")
    sizes = {r.step: (r.n, r.least) for r in word_counts.groupBy(step).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()}
    least, held = 2**62, 0
    for _, (n, low) in sorted(sizes.items(), reverse=True):  # at most 16 rows per doubling
        held += n
        if held > TABLE:
            break
        least = low
    return least


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), (remainder(folds) == 0).alias("held_out"))
    trained = docs.filter("not held_out")
    spark = docs.sparkSession
    paths = {name: fresh_path(spark, name) for name in ("subwords", "histograms", "counts", "word-counts", "blocks")}
    units = parts(trained.count(), UNIT)
    order = F.xxhash64("doc_id", "text")
    dealt = trained.select(F.pmod(order, F.lit(units)).alias("unit"), order.alias("order"), "text").repartition("unit").sortWithinPartitions("unit", "order")
    encoded = stash(dealt.select("unit", "text").mapInArrow(_contexts, CONTEXTS), "subwords", paths["subwords"], "zstd", **SMALL_GROUPS)
    sums = encoded.filter("ids is null").groupBy("a").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS]).toPandas()  # a row per subword
    context = contexts([])
    context[0][sums["a"]], context[1][sums["a"]] = sums["n"], sums[SUMS]
    classes = classes_of(*context)
    training = encoded.filter("ids is not null").select("ids")
    centres = kinds_of(stash(training.mapInArrow(_histograms(classes), "h binary"), "histograms", paths["histograms"]))
    discard(spark, paths["histograms"])

    counted = trained.select("text").mapInArrow(_count(classes, centres), COUNTED).groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    counted = stash(counted, "counts", paths["counts"])
    by_kind = [F.coalesce(F.sum(F.when(F.col("b") == k, F.col("n"))), F.lit(0)).alias(f"k{k}") for k in range(KINDS)]
    word_counts = stash(counted.filter("kind = 0").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("c"), *by_kind), "word-counts", paths["word-counts"])
    totals = word_counts.agg(F.sum("c").alias("tokens"), F.count("*").alias("distinct"), *[F.sum(f"k{k}").alias(f"k{k}") for k in range(KINDS)]).first()
    tokens, distinct = int(totals.tokens or 0), int(totals.distinct or 0)
    top = word_counts.filter(F.col("c") >= _least_count(word_counts)).toPandas()  # TABLE rows at most
    kind_totals = np.array([totals[k] or 0 for k in KIND_COUNTS], float)
    table = Table(top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), top[KIND_COUNTS].to_numpy(np.float64).reshape(-1, KINDS), kind_totals, tokens)
    model = start(*gather(counted), classes)
    train(model, training)
    shared = spark.sparkContext.broadcast((model, table))
    discard(spark, paths["counts"], paths["subwords"])  # what is still to run reads neither

    blocks = stash(docs.mapInArrow(_blocks(table.words), BLOCKS), "blocks", paths["blocks"], "zstd", **SMALL_GROUPS)
    others = blocks.filter("word is not null").select(F.col("block").alias("of"), "word").join(word_counts, "word")
    texts = blocks.filter("data is not null").select("block", "data")
    scored = texts.groupBy("block").cogroup(others.groupBy("of")).applyInArrow(_score(shared, kind_totals, tokens, distinct), SCORED)
    scored = stash(scored, "scores", compression="zstd")
    shared.destroy()
    discard(spark, paths["blocks"], paths["word-counts"])
    found = scored.filter("bin is not null").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    mixed = mixture(found["bin"].to_numpy(np.int64), found["n"].to_numpy(np.int64))
    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, base double"
    whole = scored.filter("ratios is not null").select(*[c.split()[0] for c in columns.split(", ")], "spelled", "ratios")
    whole = whole.mapInArrow(_mixed(mixed), columns + ", score double")
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op8_language(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
