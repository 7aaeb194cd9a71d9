"""The arithmetic of the language model against plain formulas, and what its tables cost."""

import math
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tests.llm import data
from tideline.llm import common, language
from tideline.llm.language import CLASSES, DIM, STRIDE, WINDOW


def made(seed=1, n=700, longest=200):
    rng = np.random.default_rng(seed)
    end, _, _, size = language.vocabulary()
    classes = rng.integers(0, CLASSES - 1, size).astype(np.int32)
    classes[end:] = CLASSES - 1
    model = language.start(rng.integers(0, 9, size).astype(float), rng.integers(0, 4, (size, CLASSES)).astype(float), classes)
    return model, [(40_000 * rng.random(rng.integers(0, longest)) ** 4).astype(np.int32) for _ in range(n)]


def softmax(a):
    a = np.exp(a - a.max(axis=-1, keepdims=True))
    return a / a.sum(axis=-1, keepdims=True)


def plain_parts(model, x):
    front, pad = WINDOW - STRIDE, language.vocabulary()[2]
    padded = x == pad
    e = np.where(padded[:, :, None], 0, model.embed[x]).astype(np.float32)
    q, k, v = e[:, front:] @ model.wq, e @ model.wk, e @ model.wv
    p = q @ k.transpose(0, 2, 1) / np.float32(math.sqrt(DIM)) + model.causal + model.place[np.maximum(model.back, 0)]
    p = softmax(p + np.where(padded, np.float32(-1e9), np.float32(0))[:, None])
    return e, q, k, v, p, p @ v + model.follows[x[:, front:]]


def plain_learn(model, x, target, rate=0.01):
    """Adam by the formulas as they stand: values of 48 classes at each place."""
    front = WINDOW - STRIDE
    flat = lambda t: t.reshape(-1, t.shape[-1])
    order = model.order.permutation(len(x))
    for a in range(0, len(order), language.BATCH):
        some, goal = x[order[a : a + language.BATCH]], target[order[a : a + language.BATCH]]
        e, q, k, v, p, z = plain_parts(model, some)
        z = softmax(z)
        flat(z)[np.arange(goal.size), model.classes[np.maximum(goal, 0)].ravel()] -= 1
        z *= ((goal >= 0) / np.float32(max(int((goal >= 0).sum()), 1)))[:, :, None]
        dv, ds = p.transpose(0, 2, 1) @ z, z @ v.transpose(0, 2, 1)
        ds = (ds - (ds * p).sum(axis=2, keepdims=True)) * p
        dq, dk = (t / np.float32(math.sqrt(DIM)) for t in (ds @ k, ds.transpose(0, 2, 1) @ q))
        de = dk @ model.wk.T + dv @ model.wv.T
        de[:, front:] += dq @ model.wq.T
        de[some == language.vocabulary()[2]] = 0
        ids = some.ravel()
        by_id = np.argsort(ids, kind="stable")
        cuts = np.flatnonzero(np.diff(ids[by_id], prepend=-1))
        place = np.bincount(np.maximum(model.back, 0).ravel(), np.where(model.back >= 0, ds.sum(axis=0), 0).ravel(), WINDOW).astype(np.float32)
        grads = [np.add.reduceat(flat(de)[by_id], cuts, axis=0), flat(e[:, front:]).T @ flat(dq), flat(e).T @ flat(dk), flat(e).T @ flat(dv), place]
        model.steps += 1
        for i, (w, g) in enumerate(zip(model.weights(), grads, strict=True)):
            at = ids[by_id[cuts]] if i == 0 else slice(None)
            m, v2 = model.moments[0][i], model.moments[1][i]
            m[at] += 0.1 * (g - m[at])
            v2[at] += 0.01 * (g * g - v2[at])
            w[at] -= rate * (m[at] / (1 - 0.9**model.steps)) / (np.sqrt(v2[at] / (1 - 0.99**model.steps)) + 1e-8)


def test_training_follows_the_plain_formulas_in_less_time():
    x, target, _ = language.windows(made()[1])
    took = {}
    for _ in range(4):
        models = {learn: made()[0] for learn in (language.Attention.learn, plain_learn)}
        for learn, model in models.items():
            model.begin()
            began = time.process_time()
            learn(model, x, target)
            took[learn] = min(took.get(learn, 1e9), time.process_time() - began)
    ours, plain = models.values()
    used = np.delete(np.arange(len(ours.embed)), language.vocabulary()[2])
    assert np.abs(ours.embed[used] - plain.embed[used]).max() < 2e-3
    assert all(np.abs(a - b).max() < 2e-3 for a, b in zip(ours.weights()[1:], plain.weights()[1:], strict=True)) and np.abs(ours.wv).max() > 0.05
    assert took[language.Attention.learn] < 0.8 * took[plain_learn], took


def test_scores_follow_the_plain_formulas():
    model, sequences = made(2, 60)
    x, target, _ = language.windows(sequences)
    rng = np.random.default_rng(3)
    model.wv[:] = rng.standard_normal(model.wv.shape)
    for scale in (1, 300):  # the exponentials of the second have no place in float32
        model.wq *= scale
        model.wv *= scale
        model.freeze()
        z = plain_parts(model, x)[-1].astype(np.float64)
        z -= z.max(axis=2, keepdims=True)
        own = np.take_along_axis(z - np.log(np.exp(z).sum(axis=2, keepdims=True)), model.classes[np.maximum(target, 0)][:, :, None], axis=2)[:, :, 0]
        want = (own + model.within[np.maximum(target, 0)])[target >= 0]
        got = language.log_probabilities(model, sequences)
        assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-3, atol=1e-3 * scale)


def test_training_bears_large_weights():
    model, sequences = made(4, 60)
    x, target, _ = language.windows(sequences)
    model.wq *= 3000
    model.begin()
    model.learn(x, target)
    assert all(np.isfinite(w).all() for w in model.weights())


def test_units_are_single_values_and_few_in_a_group_of_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 50_000, n).astype(np.int32) for n in (0, 5, 0, 300_000)]
    column = language._unit_row(texts)
    assert column.type == pa.binary() and len(column[0].as_py()) < 3 * 300_000
    for again in language._units(pa.concat_arrays([column, column])):
        assert [t.tolist() for t in again] == [t.tolist() for t in texts] and again[0].dtype == np.int32
    rows = spark.range(40, numPartitions=1)
    rows = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([rng.bytes(600_000) for _ in range(b.num_rows)], pa.binary())], ["ids"]) for b in batches), "ids binary")
    common.stash(rows, "units", str(tmp_path / "units"), "zstd", **language.SMALL_GROUPS)
    groups = [g.num_rows for f in (tmp_path / "units").glob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert sum(groups) == 40 and max(groups) <= 20, groups


def test_counts_of_what_precedes():
    rng = np.random.default_rng(6)
    end, begin, _, size = language.vocabulary()
    sequences = [rng.integers(0, 30, n).astype(np.int32) for n in (0, 1, 400)]
    counts, sums = np.zeros(size, np.int64), np.zeros((size, language.MARKS), np.int64)
    for s in sequences:
        for before, after in zip([begin, *s.tolist()], s.tolist(), strict=False):
            counts[after] += 1
            sums[after] += language._marks()[:, before]
    got = language.contexts(sequences)
    assert (got[0] == counts).all() and (got[1] == sums).all()


def test_texts_of_a_block_travel_compressed(spark):
    texts = [t or "" for t in data.texts(n=900)]
    docs = spark.createDataFrame([(i, i % 9 == 0, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string").coalesce(1)
    rows = docs.mapInArrow(language._blocks(np.array([language.END_WORD])), language.BLOCKS).collect()
    packed = [r.data for r in rows if r.word is None]
    assert sum(map(len, packed)) < 0.7 * sum(len(t.encode()) for t in texts)
    back = [r for p in packed for r in pa.ipc.open_stream(p).read_all().to_pylist()]
    assert [(r["doc_id"], r["held_out"], r["text"]) for r in back] == [(i, i % 9 == 0, t) for i, t in enumerate(texts)]
    assert len({r.block for r in rows}) == len(packed) and {r.word for r in rows} > {None}
