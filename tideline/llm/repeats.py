"""Exact removal of repeated byte strings, by prefix-free parsing.

A byte is removed if a string of ``WIDTH`` bytes that covers it also starts in a document with a smaller id.

*Parse.* Rolling-hash triggers cut each document into overlapping phrases: a place is a trigger if the
hash of its 16 bytes is the smallest (the first of equals) in some string of ``WIDTH`` bytes. Equal strings have
their trigger at the same place, so every string belongs to one phrase: the strings that share a trigger, with
all their bytes. In repetitive text the dictionary of phrases is far smaller than the text.

*Dictionary order.* Phrases meet by the hash of their trigger, in buckets of bounded size. Sorted there by trigger,
phrase and document, some triggers at a time, equal phrases are runs: all but the run's first document lose the phrase's strings. Different
phrases of one trigger can still share strings, where a repeat begins or ends. Such strings contain the 17
bytes left or right of the trigger, so only phrases of different first documents that agree there go on.

*Suffix order.* For these, each suffix of a phrase that starts one of its strings is ranked in the same way by its first
``WIDTH`` bytes (by hash, and by document within equal ranks), and again all but the first document lose it.

What is sent of a phrase or string is about 13 bytes: 88 bits of its hashes, document and place, packed per batch and
bucket. Within a batch of documents only a phrase's first document is sent, so a passage in a third of all
documents is a few entries per batch. Texts
themselves move only to where their repeats are known, and only those of documents that have some.

Defined cases: a null text counts as empty; texts shorter than ``WIDTH`` lose nothing. Rows of one id do not remove
from each other, whatever their texts. Rows with a null id neither remove nor lose bytes. An empty table
gives no rows. Other columns are kept by ``remove_repeats``, but for those named like the added ones. Names that
start with an underscore are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import IdFilter, byte_slices, parts, small_batches, stash, text_of

WIDTH, TRIGGER = 50, 16
SPAN = WIDTH - TRIGGER + 1
SIDE = SPAN // 2
#: Bytes of text per bucket of phrases, and per group of documents.
BUCKET_BYTES, CHUNK_BYTES = 16 << 20, 4 << 20
#: Bytes of text that are parsed together, and whose phrases are packed together.
TOGETHER, SEND_BYTES = 256 << 10, 4 << 20
#: Bytes of unpacked phrases that are sorted together.
SORT_BYTES = 4 << 20
_PLACE = np.uint64((1 << 26) - 1)
_rng = np.random.default_rng(4)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * _M1
    h = (h ^ h >> np.uint64(29)) * _M2
    return h ^ h >> np.uint64(32)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(19, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        _powers[size] = tuple(np.concatenate([[np.uint64(1)], np.full(size - 1, b)]).cumprod(dtype=np.uint64) for b in (_BASE, _INVERSE))
    return _powers[size]


class Hashes:
    """Hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mix((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)


def phrases(texts: list[bytes]):
    """Of each phrase: its text's number, trigger hash, phrase hash, side hashes, first string's place,
    how many more strings follow, and how far its trigger is from the first string's place."""
    out = []
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= TOGETHER):
            size += len(texts[end])
            end += 1
        part = _parse(texts[start:end])
        out.append((part[0] + start, *part[1:]))
        start = end
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _parse(texts: list[bytes]):
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths
    hashes = Hashes(data)
    grams = hashes.windows(TRIGGER)
    at = np.arange(len(grams), dtype=np.uint64)
    low = (grams & ~_PLACE) | (at & _PLACE)
    span = 1
    while span < SPAN:  # the smallest of SPAN grams, by doubling
        step = min(span, SPAN - span)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        span += step
    # strings that lie in one text
    n_strings = np.maximum(lengths - WIDTH + 1, 0)
    total = int(n_strings.sum())
    text = np.repeat(np.arange(len(texts)), n_strings)
    string = np.arange(total) - np.repeat(np.cumsum(n_strings) - n_strings, n_strings) + first[text]
    place = (low[string] & _PLACE).astype(np.int64)
    trigger = string - (string & int(_PLACE)) + place
    trigger += np.where(trigger < string, int(_PLACE) + 1, 0)
    new = np.ones(total, bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    more = np.diff(np.append(begin, total)) - 1
    text, begin, trigger = text[begin], string[begin], trigger[begin]
    phrase = hashes.of(begin, begin + more + WIDTH) ^ _mix((trigger - begin).astype(np.uint64) + _M1)
    left = hashes.of(np.maximum(trigger - SIDE, first[text]), trigger)
    right_end = np.minimum(trigger + TRIGGER + SIDE, first[text] + lengths[text])
    right = hashes.of(trigger + TRIGGER, right_end)
    return text, grams[trigger], _mix(phrase), left.astype(np.uint8), right.astype(np.uint8), begin - first[text], more, trigger - begin


def _pack(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.compress(blob, codec="zstd", asbytes=True)


def _unpacked_size(blob: bytes | pa.Buffer) -> int:
    return int.from_bytes(blob[:8], "little")


def _unpack(blob: bytes | pa.Buffer) -> bytes:
    return pa.decompress(blob[8:], _unpacked_size(blob), codec="zstd", asbytes=True)


def _write_ranges(doc_id, tag, start, more) -> bytes:
    return _pack(b"".join(a.astype(k).tobytes() for a, k in ((doc_id, np.int64), (tag, np.int32), (start, np.int32), (more, np.int32))))


def _read_ranges(blob: bytes):
    raw = _unpack(blob)
    n = len(raw) // 20
    return (
        np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int32, n, 8 * n),
        np.frombuffer(raw, np.int32, n, 12 * n), np.frombuffer(raw, np.int32, n, 16 * n),
    )


SENT = "kind int, bucket int, chunk int, blob binary"
#: Kinds of rows: packed phrases, ranges of strings that are repeats, ranges that have to be looked at.
PHRASES, REPEATED, UNSURE = 0, 1, 2


def _by_chunk(kind: int, n_chunks: int, n_buckets: int, doc_id, tag, start, more) -> list[tuple]:
    """Rows of ranges, one per group of documents."""
    chunk = tag.astype(np.int64) % n_chunks
    order = np.lexsort((start, doc_id, chunk))
    doc_id, tag, start, more, chunk = (x[order] for x in (doc_id, tag, start, more, chunk))
    cuts = np.append(np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])), len(chunk)) if len(chunk) else [0]
    return [
        (kind, int(chunk[a] % n_buckets), int(chunk[a]), _write_ranges(doc_id[a:b], tag[a:b], start[a:b], more[a:b]))
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]


def _joined(doc_id, tag, start, more):
    """Merge ranges of strings that follow or overlap each other (sorted by document and start)."""
    if not len(start):
        return doc_id, tag, start, more
    new = np.ones(len(start), bool)
    new[1:] = (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + more[:-1] + 1)
    at = np.flatnonzero(new)
    end = np.maximum.reduceat(start + more, at)
    return doc_id[at], tag[at], start[at], end - start[at]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "bucket", "chunk", "blob"])


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values in sorted columns, and each row's run."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _packed(n_buckets: int, n_chunks: int, ids, tags, found) -> list[tuple]:
    """Rows to send for phrases: those whose document here is not their first are known repeats already."""
    doc, trigger, phrase, left, right, start, more, off = found
    order = np.argsort(phrase, kind="stable")
    at, _ = _runs(phrase[order])
    least = np.minimum.reduceat(ids[doc[order]], at) if len(at) else np.empty(0, np.int64)
    known = np.zeros(len(order), bool)
    known[order] = ids[doc[order]] > np.repeat(least, np.diff(np.append(at, len(order))))
    d = doc[known]
    rows = _by_chunk(REPEATED, n_chunks, n_buckets, *_joined(ids[d], tags[d], start[known], more[known]))
    doc, trigger, phrase, left, right, start, more, off = (x[~known] for x in (doc, trigger, phrase, left, right, start, more, off))
    key = trigger >> np.uint64(24)
    bucket = (key % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(_runs(bucket[order])[0], len(order))
    for first, last in zip(cuts, cuts[1:], strict=False):
        some = order[first:last]
        b = int(bucket[some[0]])
        docs, index = np.unique(doc[some], return_inverse=True)
        short = phrase[some] >> np.uint64(16)
        raw = b"".join(a.tobytes() for a in (
            np.array([len(docs), len(some)], np.int64), ids[docs].astype(np.int64), tags[docs].astype(np.int32),
            np.diff(index, prepend=0).astype(np.int32), np.diff(start[some], prepend=0).astype(np.int32), more[some].astype(np.uint8), off[some].astype(np.uint8),
            (key[some] // np.uint64(n_buckets)).astype(np.uint32), short.astype(np.uint32), (short >> np.uint64(32)).astype(np.uint16),
            left[some], right[some],
        ))
        rows.append((PHRASES, b, -1, _pack(raw)))
    return rows


def _send(n_buckets: int, n_chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in byte_slices(batch, SEND_BYTES):
                ids, tags = (some.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
                yield _rows(_packed(n_buckets, n_chunks, ids, tags, phrases(some.column("text").cast(pa.binary()).to_pylist())))

    return run


def _read_phrases(blob: bytes | pa.Buffer, share: int, shares: int):
    """The phrases whose triggers are in one share of all."""
    raw = _unpack(blob)
    n_docs, n = np.frombuffer(raw, np.int64, 2)
    at, out = 16, []
    for kind, m in ((np.int64, n_docs), (np.int32, n_docs), (np.int32, n), (np.int32, n), (np.uint8, n), (np.uint8, n), (np.uint32, n), (np.uint32, n), (np.uint16, n), (np.uint8, n), (np.uint8, n)):
        out.append(np.frombuffer(raw, kind, int(m), at))
        at += out[-1].nbytes
    ids, tags, step, move, more, off, key, low, high, left, right = out
    some = np.flatnonzero(key % np.uint32(shares) == share)
    doc = np.cumsum(step, dtype=np.int32)[some]
    short = low[some].astype(np.uint64) | high[some].astype(np.uint64) << np.uint64(32)
    return ids[doc], tags[doc], np.cumsum(move, dtype=np.int32)[some], more[some].astype(np.int32), off[some].astype(np.int32), key[some], short, left[some], right[some]


def _order(n_buckets: int, n_chunks: int):
    """Sorts a bucket's phrases, a share of its triggers at a time, and tells which strings are repeats and which may be."""

    def run(group: pa.Table) -> pa.Table:
        rows = [tuple(r) for r in zip(*(group.filter(pc.greater(group["kind"], PHRASES))[c].to_pylist() for c in ("kind", "bucket", "chunk", "blob")), strict=True)]
        blobs = [b.as_buffer() for b in group.filter(pc.equal(group["kind"], PHRASES))["blob"]]
        del group
        shares = parts(sum(map(_unpacked_size, blobs)), SORT_BYTES)
        found = [_sorted_share([_read_phrases(b, share, shares) for b in blobs]) for share in range(shares if blobs else 0)]
        del blobs
        for kind, ranges in zip((REPEATED, UNSURE), zip(*found, strict=True), strict=False):
            rows += _by_chunk(kind, n_chunks, n_buckets, *(np.concatenate(c) for c in zip(*ranges, strict=True)))
        return pa.Table.from_batches([_rows(rows)]).select(["kind", "chunk", "blob"])

    return run


def _sorted_share(read: list[tuple]) -> tuple[tuple, tuple]:
    """Ranges (document, tag, start, how many more) of strings that are repeats, and of those that may be."""
    columns = [list(c) for c in zip(*read, strict=True)]
    read.clear()
    for k, c in enumerate(columns):
        columns[k] = np.concatenate(c)
    order = np.lexsort((columns[0], columns[6], columns[5]))  # by trigger, phrase and document
    for k, c in enumerate(columns):
        columns[k] = c[order]
    doc, tag, start, more, off, key, phrase, left, right = columns
    at, run_of = _runs(key, phrase)
    lead = doc[at]  # the first document of each phrase
    later = doc > lead[run_of]
    # phrases of one trigger that agree on a side but have different first documents
    agrees = []
    for side in (left, right):
        by = np.lexsort((side[at], key[at]))
        starts, run_at = _runs(key[at][by], side[at][by])
        differ = np.minimum.reduceat(lead[by], starts) != np.maximum.reduceat(lead[by], starts) if len(starts) else np.empty(0, bool)
        agrees.append(np.zeros(len(at), bool))
        agrees[-1][by] = differ[run_at]
    on_left, on_right = (g[run_of] for g in agrees)
    # strings with the whole left side start up to SIDE before the trigger, those with the right side from there on
    first = np.where(on_left, 0, np.maximum(off - SIDE, 0))
    last = np.where(on_right, more, np.minimum(off - SIDE, more))
    look = ~later & (on_left | on_right) & (first <= last)
    return (doc[later], tag[later], start[later], more[later]), (doc[look], tag[look], (start + first)[look], (last - first)[look])


def _keyed(docs: DataFrame, n_chunks: int) -> DataFrame:
    text = text_of()
    tag = F.hash("doc_id", text)
    return docs.withColumns({"_tag": tag, "_chunk": F.pmod(tag, F.lit(n_chunks))})


def _wanted(ranges: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """The starts and lengths of ranges by document."""
    blobs = ranges["blob"].to_pylist()
    if not blobs:
        return {}
    doc, tag, start, more = (np.concatenate(c) for c in zip(*map(_read_ranges, blobs), strict=True))
    order = np.lexsort((start, tag, doc))
    doc, tag, start, more = doc[order], tag[order], start[order], more[order]
    at, _ = _runs(doc, tag)
    return {(int(doc[a]), int(tag[a])): (start[a:b], more[a:b]) for a, b in zip(at, np.append(at[1:], len(doc)), strict=True)}


def _suffixes(n_buckets: int, n_chunks: int):
    """Sends each string of the unsure ranges as a phrase of its own."""

    def run(docs: pa.Table, ranges: pa.Table) -> pa.Table:
        wanted = _wanted(ranges)
        ids, tags, doc, start, hashes = [], [], [], [], []
        seen = set()
        for doc_id, tag, text in zip(docs["doc_id"].to_pylist(), docs["_tag"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True):
            if (doc_id, tag) not in wanted or (doc_id, tag) in seen:
                continue
            seen.add((doc_id, tag))
            begin, more = wanted[doc_id, tag]
            n = more + 1
            places = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            hashes.append(Hashes(np.frombuffer(text, np.uint8)).of(places, places + WIDTH))
            doc.append(np.full(len(places), len(ids)))
            start.append(places)
            ids.append(doc_id)
            tags.append(tag)
        if not ids:
            return pa.Table.from_batches([_rows([])])
        doc, start, hashes = np.concatenate(doc), np.concatenate(start), np.concatenate(hashes)
        none = np.zeros(len(doc), np.uint8)
        found = doc, _mix(hashes), hashes, none, none, start, none.astype(np.int64), none.astype(np.int64)
        return pa.Table.from_batches([_rows(_packed(n_buckets, n_chunks, np.array(ids, np.int64), np.array(tags, np.int32), found))])

    return run


def _cut(text: bytes, start: np.ndarray, more: np.ndarray) -> tuple[bytes, int, int]:
    """The kept bytes, how many are removed, and in how many runs."""
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + more + WIDTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), edges


def _finish(docs: pa.Table, wanted: dict) -> pa.Table:
    kept, sizes, removed, spans = [], [], [], []
    for doc_id, tag, text in zip(docs["doc_id"].to_pylist(), docs["_tag"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True):
        text = text or b""
        at = wanted.get((doc_id, tag))
        rest, n, runs = _cut(text, *at) if at is not None else (text, 0, 0)
        kept.append(rest)
        sizes.append(len(text))
        removed.append(n)
        spans.append(runs)
    out = docs.drop_columns(["_tag", "_chunk"])
    texts = [b.decode("utf-8", "ignore") for b in kept]
    for name, values, kind in (("kept", kept, pa.binary()), ("kept_text", texts, pa.string()), ("n_bytes", sizes, pa.int64()), ("n_removed", removed, pa.int64()), ("n_spans", spans, pa.int64())):
        out = out.append_column(name, pa.array(values, kind))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the bytes that stay (``kept``), their whole characters (``kept_text``), ``n_bytes``,
    ``n_removed`` and ``n_spans``."""
    small_batches(docs.sparkSession)
    docs = docs.drop("kept", "kept_text", "n_bytes", "n_removed", "n_spans")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets, n_chunks = parts(size, BUCKET_BYTES), parts(size, CHUNK_BYTES)
    keyed = _keyed(docs, n_chunks)
    texts = keyed.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_tag").alias("tag"), "text")
    sent = texts.mapInArrow(_send(n_buckets, n_chunks), SENT)
    found = stash(sent.groupBy("bucket").applyInArrow(_order(n_buckets, n_chunks), "kind int, chunk int, blob binary"), "repeats")

    unsure = found.filter(F.col("kind") == UNSURE)
    some = keyed.filter("doc_id is not null and text is not null").filter(IdFilter(_ids(unsure)).column())
    some = some.select(F.col("doc_id").cast("long").alias("doc_id"), "_tag", "text", F.col("_chunk").alias("chunk"))
    strings = some.groupBy("chunk").cogroup(unsure.select("chunk", "blob").groupBy("chunk")).applyInArrow(_suffixes(n_buckets, n_chunks), SENT)
    # a single string is sure: its runs are of equal strings, so what is still unsure differs
    again = strings.groupBy("bucket").applyInArrow(_order(n_buckets, n_chunks), "kind int, chunk int, blob binary")
    again = stash(again.filter(F.col("kind") == REPEATED), "repeated-strings").select("chunk", "blob")

    ranges = found.filter(F.col("kind") == REPEATED).select("chunk", "blob").union(again)
    loses = IdFilter(_ids(ranges))
    fields = [f for f in docs.schema.fields]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in (("kept", T.BinaryType()), ("kept_text", T.StringType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType())))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("_place").to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array(~loses.holds(places) | (places < 0)))
            yield from _finish(pa.Table.from_batches([some]).drop_columns("_place"), {}).to_batches()

    def finish(docs: pa.Table, ranges: pa.Table) -> pa.Table:
        return _finish(docs, _wanted(ranges))

    # a null id has no place
    apart = keyed.withColumn("_place", F.when(F.col("doc_id").isNull(), -1).otherwise(IdFilter.place())).mapInArrow(whole, schema)
    changed = keyed.filter(F.col("doc_id").isNotNull() & loses.column())
    changed = changed.groupBy("_chunk").cogroup(ranges.withColumnRenamed("chunk", "_chunk").groupBy("_chunk")).applyInArrow(finish, schema)
    return apart.unionByName(changed)


def _ids(ranges: DataFrame) -> DataFrame:
    """The documents of ranges, each once: all of a document's ranges are of one chunk, and meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.empty(0, np.int64)
        for batch in batches:
            got = [_read_ranges(b)[0] for b in batch.column("blob").to_pylist()]
            ids = np.unique(np.concatenate([ids, *got]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["doc_id"])

    return ranges.select("chunk", "blob").repartition("chunk").select("blob").mapInArrow(run, "doc_id long")


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes of earlier documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

