"""Document fingerprints from improbable features.

Every 64-byte window of a text gets the entropy of its byte classes. The further an entropy
lies from that of usual prose, the rarer the window counts. A window that is the rarest of its
surroundings for at least ``POPULAR`` of 64 sliding positions is a feature. Features go, in
order, into a chain of Bloom filters of 2048 bits with at most 160 features each. The
likeness of two fingerprints is the mean, over the filters of the shorter chain, of the
best bit overlap with a filter of the other, normalised so that overlap by chance is 0 and the
largest possible is 1.

Everything is read from whole texts; windows are places in the text and nothing is sampled.
A text below ``SHORT`` bytes has too few windows to choose from, so all its 8-byte strings are
features as well.

``compare_neighbours`` reads documents by descending id without a global sort: ids are cut into ranges of about equal
bytes and rows, each range is sorted (Spark spills it) and read as a stream, and the first text of a range is also sent
to the range before it. There are at most ``MOST_RANGES`` ranges, so their bounds, a number each, are bounded too. An id with more
rows than a range holds, or null ids, are cut further by how their texts start.

Defined cases: a null text counts as empty; an empty text has the empty fingerprint, whose likeness
is 1 to itself and 0 to others. Rows of equal ids are neighbours in the order of their texts. Null
ids come last, as rows of the smallest long. A table's only document is its own neighbour. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import byte_slices, parts, small_batches, text_of

WINDOW = 64
POPULAR = 16
BITS = 2048
PER_FILTER = 160
HASHES = 5
#: In texts of fewer bytes, every GRAM bytes are a feature too.
SHORT, GRAM = 256, 8
#: Entropy of usual prose over the byte classes, in bits.
USUAL = 3.0
#: Overlaps up to this part of the way from chance to the largest count as chance.
CHANCE = 0.15
#: Bytes of text that are worked on together.
CHUNK = 1 << 17
BYTES_PER_RANGE = 16 << 20
MOST_RANGES = 50_000
#: Bytes of text whose pairs are compared together.
SLICE = 1 << 20
#: Bytes by which texts of one id are cut into ranges.
STARTS = 7

#: The class of each byte: the low four bits of a mixed byte value.
CLASSES = (np.arange(256, dtype=np.uint32) * np.uint32(2654435761) >> np.uint32(20) & np.uint32(15)).astype(np.uint8)
_counts = np.arange(WINDOW + 1)
#: n log2 n, for n bytes of one class in a window, in 1/2**14.
N_LOG_N = np.round(_counts * np.log2(np.maximum(_counts, 1)) * 2**14 / WINDOW).astype(np.int32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def rarity(data: np.ndarray) -> np.ndarray:
    """How unusual the entropy of each window is; one value per window start."""
    n = len(data) - WINDOW + 1
    classes = CLASSES[data]
    total = np.zeros(n, np.int32)
    counts = np.zeros(len(data) + 1, np.uint8)  # running counts modulo 256; their differences are below that
    for k in range(16):
        np.cumsum(classes == k, dtype=np.uint8, out=counts[1:])
        total += N_LOG_N.take(counts[WINDOW:] - counts[:n])
    entropy = (6 << 14) - total
    return np.abs(entropy - int(USUAL * 2**14))


def _features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of features and the text each is in; texts lie between ``bounds``."""
    lengths = np.diff(bounds)
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(n, dtype=np.int64)
    key = (rarity(data).astype(np.int64) << 40) | ((1 << 40) - 1 - at)  # the first of equals wins
    best, span = key, 1
    while span < WINDOW:  # the rarest of the next 64 windows
        best = np.maximum(best[:-span], best[span:]) if len(best) > span else best[:0]
        span *= 2
    owner = np.repeat(np.arange(len(lengths)), lengths)
    popular = np.zeros(n, np.int64)
    if len(best):
        whole = owner[: len(best)] == owner[2 * WINDOW - 2 :][: len(best)]  # all 64 windows in one text
        winner = ((1 << 40) - 1) - (best[whole] & ((1 << 40) - 1))
        popular = np.bincount(winner, minlength=n)
    found = np.flatnonzero(popular >= POPULAR)
    few = np.setdiff1d(np.flatnonzero(lengths >= WINDOW), owner[found])
    extra = [bounds[d] + int(key[bounds[d] : bounds[d + 1] - WINDOW + 1].argmax()) for d in few]
    if extra:
        found = np.sort(np.append(found, extra)).astype(np.int64)
    return found, owner[found]


def _hash_windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(data[at[:, None] + np.arange(WINDOW)]).view("<u8")
    h = np.full(len(at), np.uint64(0x243F6A8885A308D3))
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * _MIX
        h ^= h >> np.uint64(29)
    h = (h ^ h >> np.uint64(32)) * _MIX
    return h ^ h >> np.uint64(31)


def digests(texts: list[bytes]) -> list[np.ndarray]:
    """The chain of each text: a row of packed bits per filter, with its features in the last two bytes."""
    out = []
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        out += _digest_chunk(texts[start:end])
        start = end
    return out


def _digest_chunk(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    at, owner = _features(data, bounds)
    hashes = _hash_windows(data, at) if len(at) else np.empty(0, np.uint64)
    for d, t in enumerate(texts):
        if 0 < len(t) < SHORT:
            grams = {t[i : i + GRAM] for i in range(max(1, len(t) - GRAM + 1))}
            own = sorted(int.from_bytes(hashlib.blake2b(g, digest_size=8).digest(), "little") for g in grams)
            hashes = np.append(hashes, np.array(own, np.uint64))
            owner = np.append(owner, np.full(len(own), d))
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))  # equal features of a text count once
    hs, ow = hashes[order], owner[order]
    first = np.ones(len(hs), bool)
    first[1:] = (hs[1:] != hs[:-1]) | (ow[1:] != ow[:-1])
    kept = order[first]
    kept = kept[np.lexsort((kept, owner[kept]))]
    hashes, owner = hashes[kept], owner[kept]
    per_text = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    chains = -(-per_text // PER_FILTER)
    first_filter = np.cumsum(chains) - chains
    filters = first_filter[owner] + rank // PER_FILTER if len(owner) else np.empty(0, np.int64)
    bits = np.zeros((int(chains.sum()), BITS), bool)
    for k in range(HASHES):
        bits[filters, (hashes >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    sizes = np.bincount(filters, minlength=len(packed)).astype("<u2") if len(filters) else np.zeros(0, "<u2")
    packed = np.concatenate([packed, sizes.view(np.uint8).reshape(-1, 2)], axis=1) if len(packed) else packed.reshape(0, BITS // 8 + 2)
    return [packed[a : a + c] for a, c in zip(first_filter, chains, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 (as by chance) to 1 (equal); the same both ways."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if len(a) > len(b) or (len(a) == len(b) and a.tobytes() > b.tobytes()):
        a, b = b, a
    x, y = (np.unpackbits(v[:, :-2], axis=1).astype(np.float32) for v in (a, b))
    sizes = np.ascontiguousarray(a[:, -2:]).view("<u2")[:, 0].astype(float)
    ones_x, ones_y = x.sum(axis=1)[:, None].astype(float), y.sum(axis=1)[None, :].astype(float)
    largest, chance = np.minimum(ones_x, ones_y), ones_x * ones_y / BITS
    floor = chance + CHANCE * (largest - chance)
    score = np.clip(((x @ y.T) - floor) / np.maximum(largest - floor, 1e-9), 0, 1)
    return float(min(1.0, (score.max(axis=1) * sizes).sum() / sizes.sum()))


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint``, the hex digits of the chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            prints = [d.tobytes().hex() for d in digests(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _edited(text: str, other: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _start(text: Column) -> Column:
    """The first bytes of a text as a number, in the order of texts."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, STARTS)), 2 * STARTS, "0"), 16, 10).cast("long")


def _cuts(keyed: DataFrame) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Keys that end ranges, and for a key that ends several, the starts of texts that end all of them but the last.

    A row weighs 1, and 1 more for every mean size that its text has, so a range has at most twice the mean of
    bytes and of rows, but for a text that is longer alone.
    """
    size, rows = keyed.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = min(parts(size or 0, BYTES_PER_RANGE), MOST_RANGES)
    if n == 1:
        return np.empty(0, np.int64), {}
    weight = (1 + F.octet_length("text") / F.lit(size / rows)).cast("int")
    weighed = keyed.select("key", F.explode(F.array_repeat(F.lit(0), weight)))
    shares = [k / n for k in range(1, n)]
    cuts = np.array(weighed.agg(F.percentile_approx("key", shares, max(10_000, 20 * n))).first()[0], np.int64)
    keys, times = np.unique(cuts, return_counts=True)
    starts = {}
    for bits in {int(k).bit_length() for k in times if k > 1}:  # as many numbers at once as there are ranges, twice at most
        own = {int(key): int(k) for key, k in zip(keys, times, strict=True) if k > 1 and int(k).bit_length() == bits}
        shares = [j / 2**bits for j in range(1, 2**bits)]
        hot = keyed.sparkSession.createDataFrame([(key,) for key in own], "key long")
        found = keyed.join(F.broadcast(hot), "key").groupBy("key").agg(F.percentile_approx(_start(F.col("text")), shares, max(10_000, 20 << bits)))
        for key, ends in found.collect():
            starts[key] = np.array(ends, np.int64)[np.arange(1, own[key]) * 2**bits // own[key] - 1]
    return cuts, starts


def _in_ranges(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``range``, numbered in reading order."""
    cuts, starts = _cuts(keyed)
    sent = keyed.sparkSession.sparkContext.broadcast((cuts, starts))

    @F.pandas_udf("int")
    def in_range(keys: pd.Series, begins: pd.Series) -> pd.Series:
        cuts, starts = sent.value
        at, key = np.searchsorted(cuts, keys, side="left"), keys.to_numpy()
        for hot in set(starts) & set(key[np.searchsorted(cuts, key, side="right") - at > 1].tolist()):
            own = key == hot
            at[own] += np.searchsorted(starts[hot], begins[own], side="left")
        return pd.Series(at)

    return keyed.withColumn("start", _start(F.col("text"))).withColumn("range", in_range("key", "start"))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each against the next one of its range; a range ends with the guest from the next one."""
    last = None
    for batch in batches:
        for some in byte_slices(batch, SLICE):
            new = list(zip(*(some.column(c).to_pylist() for c in ("range", "doc_id", "text")), strict=True))
            prints = digests([text.encode() for _, _, text in new])
            rows = [(*row, chain) for row, chain in zip(new, prints, strict=True)]
            rows = rows if last is None else [last, *rows]
            last = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0]]
            edits = [_edited(a[2], b[2]).encode() for a, b in pairs]
            changed = digests(edits)
            out = [
                (a[1], len(a[2]), hashlib.sha256(edit).hexdigest(), a[3].tobytes().hex(), c.tobytes().hex(), likeness(a[3], c), likeness(a[3], b[3]))
                for (a, b), edit, c in zip(pairs, edits, changed, strict=True)
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(OUT.names, row, strict=True)) for row in out], OUT)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's."""
    small_batches(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    key = F.coalesce(F.bitwise_not(doc_id), F.lit(np.iinfo(np.int64).max))  # ascending where ids descend
    rows = _in_ranges(docs.select(doc_id.alias("doc_id"), text_of().alias("text"), key.alias("key")))
    # a row per range, at most MOST_RANGES
    order = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy()))
    firsts = rows.groupBy("range").agg(F.min(F.struct("key", "start")).alias("first")).select("range", "first.*", before.alias("before"))
    guests = rows.join(F.broadcast(firsts), ["range", "key", "start"]).groupBy("before").agg(F.min("text").alias("text"))
    placed = rows.select("range", F.lit(False).alias("guest"), "key", "doc_id", "text").unionByName(
        guests.select(F.col("before").alias("range"), F.lit(True).alias("guest"), "text"), allowMissingColumns=True
    )
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return placed.repartition("range").sortWithinPartitions("range", "guest", "key", "text").select("range", "doc_id", "text").mapInArrow(_compare, schema)


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
