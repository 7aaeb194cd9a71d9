import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.data import documents, empty
from tideline.llm import packing, sharding


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    from tests.llm.data import texts

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    some = [x or "" for x in texts()] + ["a <|endoftext|> b", "x" * 5000, "it's    odd white\r\n"]
    for text in some:
        assert packing.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 4096, 5000])
def test_cut(n):
    pieces = packing.cut(n)
    assert sum(length for _, length in pieces) == n
    assert all(length == 2048 for _, length in pieces[1:]) and 0 < pieces[0][1] <= 2048
    assert [s for s, _ in pieces] == np.cumsum([0] + [length for _, length in pieces])[:-1].tolist()


def test_pack_documents(spark):
    docs = documents(spark)
    rows = packing.pack_documents(docs, length=64).collect()
    want = defaultdict(int)
    for r in docs.select("doc_id", "text").collect():
        ids = np.append(packing.encode(r.text or ""), 0).astype("<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), 64)):
            want[r.doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())] += 1
    got = defaultdict(int)
    places = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= sum(r.length for r in rows) / 64 * 1.05 + 1


@pytest.mark.parametrize("fit", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(fit):
    lengths = np.random.default_rng(0).integers(1, 40, 300)
    bins, offsets = packing.best_fit(lengths, (100.0, 5.0, 3000.0), fit=fit)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 5 and (own**2).sum() <= 3000
        assert sorted(offsets[bins == b]) == sorted(np.cumsum(sorted_by(own, offsets[bins == b])) - sorted_by(own, offsets[bins == b]))


def sorted_by(values, keys):
    return values[np.argsort(keys)]


def test_pack_empty(spark):
    assert packing.pack_documents(empty(spark)).collect() == []


def test_shards(spark):
    docs = documents(spark)
    rows = sharding.assign_shards(docs, 4).collect()
    assert len(rows) == docs.count()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.bytes
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.bytes for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert sharding.assign_shards(empty(spark), 4).collect() == []


def test_a_group_larger_than_a_shard_is_cut(spark):
    docs = spark.createDataFrame([(i, "same text " * 10 if i % 3 else f"{i} " * 9) for i in range(900)], "doc_id long, text string")
    sizes = defaultdict(int)
    for r in sharding.assign_shards(docs, 8).collect():
        sizes[r.shard] += r.bytes
    assert len(sizes) == 8 and max(sizes.values()) < 1.2 * min(sizes.values())


def test_equal_texts_share_a_shard(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50} " * (1 + i % 7)) for i in range(700)], "doc_id long, text string")
    shards = {}
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in sharding.assign_shards(docs, 3).collect():
        assert shards.setdefault(text[r.doc_id], r.shard) == r.shard
