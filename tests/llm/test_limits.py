"""What operators leave on disk and hold in memory while they run."""

import random
import time
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.data import documents, words
from tideline.llm import common, language, repeats, stages


def held(spark, kind):
    """Files of shuffles or broadcasts."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = {f for d in disk.localDirsString() for f in Path(d).rglob(f"{kind}_*")}
    return own if kind == "shuffle" else own | {f for f in Path(spark.sparkContext._temp_dir).iterdir() if f.stat().st_size > 1 << 20}


def left(spark, kind, before):
    end = time.time() + 10  # files go in the background
    while held(spark, kind) - before and time.time() < end:
        time.sleep(0.1)
    return held(spark, kind) - before


def test_a_stash_leaves_no_shuffle(spark):
    before, setting = held(spark, "shuffle"), spark.conf.get(common.CLEAN_UP, None)
    got = common.stash(spark.range(1000).repartition(3, "id").groupBy(F.col("id") % 7).count(), "test")
    assert not left(spark, "shuffle", before) and spark.conf.get(common.CLEAN_UP, None) == setting
    assert got.count() == 7


def test_language_leaves_no_model(spark):
    before = held(spark, "broadcast")
    assert language.score_documents(documents(spark, n=60)).count()
    assert not [f for f in left(spark, "broadcast", before) if f.exists() and f.stat().st_size > 4 << 20]


def bucket(rng, n):
    """A bucket of phrases of ``n`` documents, some with passages of others."""
    texts = [words(rng, 500) for _ in range(n)]
    texts = [t + " " + rng.choice(texts)[:400] if rng.random() < 0.5 else t for t in texts]
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + 200)), pa.array(np.zeros(200, np.int32)), pa.array(texts[a : a + 200])], ["doc_id", "tag", "text"]) for a in range(0, n, 200)]
    return pa.Table.from_batches(list(repeats._send(1, 4)(iter(batches)))), sum(map(len, texts))


def ranges(table):
    return sorted((r["kind"], r["chunk"], r["blob"]) for r in table.to_pylist())


def test_a_bucket_is_sorted_by_shares(monkeypatch):
    group, size = bucket(random.Random(3), 2400)
    tracemalloc.start()
    by_shares = repeats._order(1, 4)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    monkeypatch.setattr(repeats, "SORT_BYTES", 1 << 40)
    assert ranges(by_shares) == ranges(repeats._order(1, 4)(group))
    assert by_shares.num_rows and peak < 5 * size, (peak / size, size)


def evaluators(node):
    """The most Python evaluators that stand in one stage on the way to a node, and in any stage below it."""
    below = [evaluators(node.children().apply(i)) for i in range(node.children().size())]
    here, most = (max((b[k] for b in below), default=0) for k in (0, 1))
    name = node.nodeName()
    here = 0 if "Exchange" in name else here + any(x in name for x in ("Python", "Arrow", "Pandas"))
    return here, max(here, most)


def test_a_task_of_near_copies_has_one_python_worker(spark):
    rng = random.Random(5)
    texts = [words(rng, 40) for _ in range(30)]
    rows = [(i, texts[i % 30], "en", "web", 1) for i in range(90)] + [(7, texts[1], "en", "web", 1), (3, None, "en", "web", 1), (None, texts[2], "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = stages.keep_one_of_each(spark, docs, "")
        assert evaluators(kept._jdf.queryExecution().executedPlan())[1] == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted([*range(30), 3])


def peak_of(batches):
    tracemalloc.start()
    n = sum(b.num_rows for b in batches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, peak


def test_language_works_on_short_stretches(spark, monkeypatch):
    rng = random.Random(4)
    texts = [words(rng, 400) for _ in range(3200)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3200) // 800), pa.array(texts)], ["unit", "text"])
    classes = language.cluster(language._sequences(language.Words([t.encode() for t in texts[:100]])))
    size = sum(map(len, texts))
    for run, most in ((language._contexts, 10.5), (language._count(classes, np.random.default_rng(1).random((language.KINDS, language.CLASSES))), 8)):
        n, peak = peak_of(run(iter([batch])))
        assert n and peak < most * size, (n, peak / size, size)
    units = [b.column("ids").to_pylist() for b in language._contexts(iter([batch])) if b.column("ids").null_count == 0]
    monkeypatch.setattr(language, "TOGETHER", 1 << 30)
    assert units == [b.column("ids").to_pylist() for b in language._contexts(iter([batch])) if b.column("ids").null_count == 0]
    assert len(units) == 4


def test_language_sends_small_batches(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.unset(n)
    try:
        language.score_documents(documents(spark, n=20))
        assert [int(spark.conf.get(n)) for n in names] == [common.TEXTS_PER_BATCH, common.BYTES_PER_BATCH]
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
