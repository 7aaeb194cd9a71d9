"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where more than half of the hashes of its 3-word shingles have it.
Fingerprints link at ``RADIUS`` or fewer differing bits.

*Covering.* Every bit gets a nonzero vector of ``RADIUS + 1`` bits, and every nonzero vector ``v`` a mask
of the bits whose vector has an odd product with ``v``. The vectors of any ``RADIUS`` bits leave some ``v`` that
is orthogonal to all of them, so that mask holds none of these bits: every pair within the radius has equal masked
bits, and collides, in one of the seven tables. Nothing is left to chance.

Members of a bucket of up to ``TOGETHER`` fingerprints are compared with each other, and only a
spanning forest of their links goes on. In a crowded bucket no pairs are formed: two fingerprints differ in two
bits or fewer exactly if they share a neighbour, a value at most one bit away from each. Every member names its 65
neighbours, and the at most 65 fingerprints around one neighbour link.

Equal fingerprints are one node from the start, so copies cost nothing.

Defined cases: null, empty and wordless texts have the fingerprint zero and link like any other. Fewer than three
words are one shingle. Very long texts are worked on in stretches. Repeated rows have one node; rows of one id with
different texts have one each. A null id is kept and gets the smallest other id of its component, if any. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tideline.llm.common import small_batches, stash, text_of
from tideline.llm.graph import components

WORDS, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Bytes of text that are split into words at once.
STRETCH = 1 << 20
#: Fingerprints of a bucket that are compared with each other; larger buckets use neighbours.
TOGETHER = 16
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes, size: int = STRETCH) -> Iterator[list[bytes]]:
    """The words of a text, in lists from stretches of about ``size`` bytes."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + size)
        end = gap.start() if gap else len(text)
        yield text[start:end].split()
        start = end + 1


def _hashes(words: list[bytes], n: int) -> np.ndarray:
    """The hash of every ``n`` adjacent words, joined by spaces."""
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n + 1]
    return np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[n - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint of a text, upper-case letters of ASCII as lower-case ones."""
    ones, total, before = np.zeros(BITS, np.int64), 0, []
    for words in word_lists(text.lower()):
        words = before + words
        if len(words) >= WORDS:
            h = _hashes(words, WORDS)
            ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
            total += len(h)
        before = words[1 - WORDS :]
    if not total and before:
        return int(_hashes(before, len(before))[0])
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of which some one has none of any ``radius`` bits."""
    vectors = range(1, 2 << radius)
    return [sum(1 << i for i in range(bits) if (vectors[i % len(vectors)] & v).bit_count() % 2) for v in vectors]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [_signed(fingerprint(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed number, of every document."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return own.mapInArrow(_fingerprints, "doc_id long, fp long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join all linked members of the small buckets of a batch, no link twice."""
    for batch in batches:
        members = batch.column("members")
        nodes, sizes = members.flatten(), np.diff(members.offsets.to_numpy())
        prints = nodes.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        bucket = np.repeat(np.arange(len(sizes)), sizes)
        _, same = np.unique(prints, return_inverse=True)
        root = np.arange(same.max(initial=-1) + 1)
        left, right = [], []
        for step in range(1, TOGETHER):
            a = np.flatnonzero(bucket[step:] == bucket[:-step]) if len(bucket) > step else np.empty(0, np.int64)
            a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= RADIUS]
            for i in a.tolist():
                x, y = same[i], same[i + step]
                while root[x] != x:
                    root[x] = x = root[root[x]]
                while root[y] != y:
                    root[y] = y = root[root[y]]
                if x != y:
                    root[x] = y
                    left.append(i)
                    right.append(i + step)
        yield pa.RecordBatch.from_arrays([nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))], ["a", "b"])


def _neighbours(value: Column) -> Column:
    return F.array(value, *[value.bitwiseXOR(F.lit(_signed(1 << i)).cast("long")) for i in range(BITS)])


def links(nodes: DataFrame) -> DataFrame:
    """``a`` and ``b``: links that connect exactly the nodes that a chain of links within the radius connects.

    ``nodes`` has one ``node`` per fingerprint, a struct with the field ``fp``.
    """
    tables = [F.struct(F.lit(t).alias("t"), F.col("node.fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key")) for t, m in enumerate(covering_masks())]
    keyed = nodes.select("node", F.inline(F.array(*tables)))
    shared = stash(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    met = stash(keyed.join(shared, ["t", "key"]), "met")
    small = met.filter(F.col("n") <= TOGETHER).groupBy("t", "key").agg(F.collect_list("node").alias("members")).select("members")
    node = nodes.schema["node"].dataType.simpleString()
    near = small.mapInArrow(_forest, f"a {node}, b {node}")
    crowded = met.filter(F.col("n") > TOGETHER).select("node").distinct()
    around = crowded.select("node", F.explode(_neighbours(F.col("node.fp"))).alias("z")).groupBy("z").agg(F.collect_list("node").alias("members"))
    joined = around.filter(F.size("members") > 1).select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return near.union(joined.filter("a <> b").distinct())


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    own = stash(fingerprints(docs, id_col, text_col), "fingerprints")
    least = own.groupBy("fp").agg(F.min("doc_id").alias("id"))
    # the smallest node of a component has its smallest id; nodes without any come last
    node = F.struct(F.col("id").isNull().alias("nameless"), F.coalesce("id", F.lit(0)).alias("id"), "fp").alias("node")
    nodes = stash(least.select(node), "prints")
    labels = components(links(nodes))
    first = F.coalesce("comp", "node")
    classes = nodes.join(labels, "node", "left").select("node.fp", F.when(~first["nameless"], first["id"]).alias("component_id"))
    return own.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
