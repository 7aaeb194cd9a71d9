import os
import random

import pytest
from pyspark.sql import functions as F

from tests.test_changelog import FRAME, applied, frame
from tideline.operators.changelog import to_row_kinds
from tideline.operators.envelope import normalize_envelope
from tideline.plans.mirror import start_mirror
from tideline.sinks.debug import read_debug
from tideline.streaming import apply
from tideline.streaming.apply import compact_applied, drop_compacted, read_applied, start_apply, write_batch
from tideline.streaming.commits import Commits, read_commits, read_fan_out
from tideline.streaming.jobs import envelope_stream, start_debug, start_envelope_files, start_fan_out, start_rows, start_topic_in_order

KEYS, ORDER = ["id"], ["ts_ms", "pos"]


def random_changes(seed, count=120):
    rnd = random.Random(seed)
    out = []
    for pos in range(count):
        key, other = rnd.randrange(12), rnd.randrange(12)
        op = rnd.choice("cuudu")
        if op == "c":
            out.append(("c", None, (key, f"c{pos}"), pos))
        elif op == "d":
            out.append(("d", (key, "x"), None, pos))
        else:
            out.append(("u", (key, "x"), (other if rnd.random() < 0.2 else key, f"u{pos}"), pos))
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_batches(spark, tmp_path, seed):
    changes = random_changes(seed)
    base = spark.createDataFrame([(i, "base") for i in range(20)], "id BIGINT, v STRING")
    expected = applied(frame(spark, *changes), base)
    # batches arrive in any order and mix old and new changes
    random.Random(seed).shuffle(changes)
    path, size = str(tmp_path / "t"), 50 + seed
    for i in range(0, len(changes), size):
        write_batch(frame(spark, *changes[i : i + size]), i // size, path, KEYS, ORDER)
    assert rows(read_applied(spark, path, KEYS, base)) == expected
    # a batch that runs again changes nothing
    write_batch(frame(spark, *changes[:size]), 0, path, KEYS, ORDER)
    assert compact_applied(spark, path, KEYS) == (len(changes) - 1) // size
    assert rows(read_applied(spark, path, KEYS, base)) == expected


def test_batches_after_a_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(frame(spark, ("c", None, (1, "a"), 1), ("d", (2, "x"), None, 9)), 0, path, KEYS, ORDER)
    compact_applied(spark, path, KEYS)
    # the delete of key 2 is remembered by the compaction
    write_batch(frame(spark, ("c", None, (2, "late"), 5), ("u", (1, "a"), (1, "b"), 10)), 1, path, KEYS, ORDER)
    assert rows(read_applied(spark, path, KEYS)) == [(1, "b")]
    assert compact_applied(spark, path, KEYS) == 1
    assert rows(read_applied(spark, path, KEYS)) == [(1, "b")]


def test_drop_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(frame(spark, ("c", None, (1, "a"), 1)), 0, path, KEYS, ORDER)
    compact_applied(spark, path, KEYS)
    write_batch(frame(spark, ("c", None, (2, "b"), 2)), 1, path, KEYS, ORDER)
    compact_applied(spark, path, KEYS)
    drop_compacted(spark, path)
    assert [p.name for p in (tmp_path / "t" / "compacted").iterdir() if "=" in p.name] == ["upto=1"]
    assert not [p for p in (tmp_path / "t" / "changes").iterdir() if "=" in p.name]
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "b")]
    # nothing new: the compaction stays as it is
    assert compact_applied(spark, path, KEYS) == 1
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "b")]
    write_batch(frame(spark, ("u", (2, "b"), (2, "c"), 3)), 2, path, KEYS, ORDER)
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "c")]


def test_unfinished_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        read_applied(spark, path, KEYS)
    write_batch(frame(spark, ("c", None, (1, "a"), 1)), 0, path, KEYS, ORDER)
    write_batch(frame(spark, ("c", None, (2, "b"), 2)), 1, path, KEYS, ORDER)
    (tmp_path / "t" / "changes" / "batch_id=1" / "_SUCCESS").unlink()
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a")]
    assert compact_applied(spark, path, KEYS) == 0
    # the repetition of the batch is not lost to the compaction
    write_batch(frame(spark, ("c", None, (2, "b"), 2)), 1, path, KEYS, ORDER)
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "b")]
    assert compact_applied(spark, path, KEYS) == 1
    (tmp_path / "t" / "compacted" / "upto=1" / "_SUCCESS").unlink()
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "b")]
    assert compact_applied(spark, path, KEYS) == 1
    assert rows(read_applied(spark, path, KEYS)) == [(1, "a"), (2, "b")]


def test_stream_of_files_restarts_where_it_stopped(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    changes = random_changes(7, 90)
    for i in range(3):
        frame(spark, *changes[i * 30 : i * 30 + 30]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(source)
        start_apply(stream, path, KEYS, ORDER).awaitTermination()
    batches = spark.read.parquet(f"{path}/changes").select("batch_id").distinct().count()
    assert batches == 3
    assert rows(read_applied(spark, path, KEYS)) == applied(frame(spark, *changes))


def test_a_lost_checkpoint_is_noticed(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    frame(spark, ("c", None, (1, "a"), 1)).write.parquet(source)
    stream = spark.readStream.schema(FRAME).parquet(source)
    start_apply(stream, path, KEYS, ORDER).awaitTermination()
    start_apply(stream, path, KEYS, ORDER).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_apply(stream, path, KEYS, ORDER, checkpoint=str(tmp_path / "new"))


@pytest.mark.parametrize("seed", range(4))
def test_apply_equals_one_change_at_a_time(spark, seed):
    changes = random_changes(100 + seed)
    table = {i: "base" for i in range(20)}
    base = spark.createDataFrame(list(table.items()), "id BIGINT, v STRING")
    for op, before, after, _ in changes:
        if before:
            table.pop(before[0], None)
        if after:
            table[after[0]] = after[1]
    random.Random(seed).shuffle(changes)
    assert applied(frame(spark, *changes), base) == sorted(table.items())


def test_text_to_mirror(spark, tmp_path):
    source, lines, path = (str(tmp_path / n) for n in ("in", "lines", "t"))
    changes = random_changes(3, 60)
    frame(spark, *changes).write.parquet(source)
    texts = normalize_envelope(spark.readStream.schema(FRAME).parquet(source))
    start_envelope_files(texts, lines, str(tmp_path / "c")).awaitTermination()
    env = envelope_stream(spark, lines, "id BIGINT, v STRING").withColumn("pos", F.col("ts_ms"))
    start_mirror(env, path, KEYS, ["pos"]).awaitTermination()
    assert rows(read_applied(spark, path, KEYS)) == applied(frame(spark, *changes))


def test_jdbc_batch(spark, monkeypatch):
    """The frames handed to the two JDBC writers, without a database."""
    sent = {}

    def deletes(keys, url, table, staging, mutation, **options):
        sent["deleted"] = (rows(keys), url, table, staging, mutation, options)

    def inserts(written, url, table, **options):
        sent["inserted"] = (sorted(tuple(r) for r in written.collect()), url, table, options)

    monkeypatch.setattr(apply, "delete_rows_jdbc", deletes)
    monkeypatch.setattr(apply, "insert_rows_jdbc", inserts)
    env = frame(spark, ("c", None, (1, "a"), 1), ("u", (1, "a"), (2, "b"), 2), ("d", (3, "x"), None, 3))
    apply.apply_batch_jdbc(env, "jdbc:x", "t", "s", KEYS, ORDER, mutation=True, user="u")
    assert sent["deleted"] == ([(1,), (2,), (3,)], "jdbc:x", "t", "s", True, {"user": "u"})
    assert sent["inserted"] == ([("+I", 2, "b")], "jdbc:x", "t", {"user": "u"})


def test_fan_out_stream(spark, tmp_path):
    changes = [("c", None, (i, "a"), i, "d", f"t{i % 2}") for i in range(6)]
    frame(spark, *changes).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).parquet(str(tmp_path / "in"))
    start_fan_out(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("db", "table").count().collect()
    assert sorted(tuple(r) for r in got) == [("d", "t0", 3), ("d", "t1", 3)]


def test_rows_stream(spark, tmp_path):
    frame(spark, ("c", None, (1, "a"), 1), ("d", (1, "a"), None, 2)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).parquet(str(tmp_path / "in"))
    start_rows(to_row_kinds(stream), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "out")).collect()] == [(1, "a")]


def test_debug_stream(spark, tmp_path):
    frame(spark, *[("c", None, (i, "a"), i) for i in range(30)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).parquet(str(tmp_path / "in"))
    kinds = stream.select(F.lit("+I").alias("row_kind"), "after.*")
    start_debug(kinds, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(f"+I[{i}, a]" for i in range(30))


def test_fan_out_refuses_another_checkpoint(spark, tmp_path):
    frame(spark, ("c", None, (1, "a"), 1, "d", "t")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).parquet(str(tmp_path / "in"))
    start_fan_out(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_fan_out(stream, str(tmp_path / "out"), str(tmp_path / "other"))


def test_fan_out_shows_whole_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        changes = [("c", None, (k, "a"), 10 * i + k, "d", f"t{k % 2}") for k in range(6) if i != 1 or k % 2]
        frame(spark, *changes).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(source)
    start_fan_out(stream, out, str(tmp_path / "c")).awaitTermination()
    state = read_commits(spark, out)
    assert state.last == 2 and state.runs == {"db=d/table=t0": [[0, 0], [2, 2]], "db=d/table=t1": [[0, 2]]}
    # a batch that was cut off after one table, and a draft of its commit
    frame(spark, ("c", None, (9, "x"), 99, "d", "t0")).write.parquet(f"{out}/batch_id=3/db=d/table=t0")
    open(f"{out}/_commits-3.draft", "w").write("{")
    seen = read_fan_out(spark, out)
    assert sorted(tuple(r) for r in seen.groupBy("db", "table", "batch_id").count().collect()) == [
        ("d", "t0", 0, 3), ("d", "t0", 2, 3), ("d", "t1", 0, 3), ("d", "t1", 1, 3), ("d", "t1", 2, 3)
    ]
    assert seen.filter("pos = 99").count() == 0
    assert read_fan_out(spark, out, ["d.t1"], since=1).count() == 3
    assert read_fan_out(spark, out, ["d.unknown"]).count() == 0
    assert {r.v for r in read_fan_out(spark, out, ["d.t0"]).select("after.v").collect()} == {"a"}


def test_fan_out_read_before_the_first_batch(spark, tmp_path):
    with pytest.raises(ValueError, match="no whole batch"):
        read_fan_out(spark, str(tmp_path))


def test_commit_runs():
    state = Commits()
    for batch, folders in enumerate((["a"], ["a", "b"], [], ["b"], ["b"])):
        state = state.adding(batch, "{}", folders)
    assert state.runs == {"a": [[0, 1]], "b": [[1, 1], [3, 4]]} and state.last == 4


def test_topic_stream_in_order(spark, tmp_path):
    rows = spark.range(600).selectExpr("CAST(id AS STRING) AS value", "CAST(id % 3 AS INT) AS partition", "(id * 7) % 600 AS at")
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    sent = []

    def send(part, bootstrap, topic, opts):
        sent.append([(bootstrap, topic, opts)] + [tuple(r) for r in part.collect()])

    start_topic_in_order(stream, ["at"], 3, "h:1", "t", str(tmp_path / "c"), {"acks": "all"}, write=send).awaitTermination()
    assert len(sent) == 2 and all(batch[0] == ("h:1", "t", {"acks": "all"}) for batch in sent)
    assert sum(len(batch) - 1 for batch in sent) == 600
    for batch in sent:
        for k in range(3):
            places = [int(value) * 7 % 600 for value, partition in batch[1:] if partition == k]
            assert places and places == sorted(places)


def test_debug_stream_in_order(spark, tmp_path):
    frame(spark, *[("c", None, (i, "a"), (i * 11) % 30) for i in range(30)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kinds = stream.select(F.lit("+I").alias("row_kind"), "after.*", "pos")
    start_debug(kinds, str(tmp_path / "out"), str(tmp_path / "c"), order_by=["pos"]).awaitTermination()
    lines = [r.line for r in read_debug(spark, str(tmp_path / "out")).orderBy("position").collect()]
    assert sorted(lines) == sorted(f"+I[{i}, a]" for i in range(30))
    batches = len([f for f in os.listdir(tmp_path / "out") if f.startswith("batch_id=")])
    places = [int(line[3:].split(",")[0]) * 11 % 30 for line in lines]
    assert sum(b < a for a, b in zip(places, places[1:])) < batches
