import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.test_changelog import applied, frame
from tests.test_streaming import KEYS, ORDER, random_changes, rows
from tideline.operators.envelope import normalize_envelope
from tideline.plans import mirror
from tideline.streaming import buckets as store


def write(df, i, path, **options):
    store.write_batch(df, i, path, KEYS, ORDER, **{"buckets": 4, "merge_after": 2} | options)


def snapshot(spark, n=20):
    base = spark.createDataFrame([(i, "base") for i in range(n)], "id BIGINT, v STRING")
    return base, base.select(F.struct("*").alias("after"))


def files(path):
    found = {}
    for folder, _, names in os.walk(f"{path}/data"):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


@pytest.mark.parametrize("merge_after", [1, 3])
def test_any_split_into_batches(spark, tmp_path, merge_after):
    changes = random_changes(merge_after)
    base, images = snapshot(spark)
    expected = applied(frame(spark, *changes), base)
    random.Random(merge_after).shuffle(changes)
    path = str(tmp_path / "t")
    store.write_base(images, frame(spark, changes[0]), path, KEYS, ORDER, buckets=4)
    for i in range(0, len(changes), 30):
        write(frame(spark, *changes[i : i + 30]), i // 30, path, merge_after=merge_after)
        # a batch that runs again changes nothing
        before = store.read_manifest(spark, path)
        write(frame(spark, *changes[i : i + 30]), i // 30, path, merge_after=merge_after)
        assert store.read_manifest(spark, path) == before
    assert max(map(len, before.parts.values())) <= merge_after
    assert rows(store.read_table(spark, path)) == expected
    store.merge_parts(spark, path)
    assert rows(store.read_table(spark, path)) == expected
    store.rebucket(spark, path, 7)
    assert store.read_manifest(spark, path).buckets == 7 and rows(store.read_table(spark, path)) == expected
    dropped = store.drop_replaced(spark, path)
    assert dropped and store.drop_replaced(spark, path) == 0
    assert rows(store.read_table(spark, path)) == expected
    # a late change of a removed key stays without effect after all of this
    gone = next(c for c in sorted(changes, key=lambda c: -c[3]) if c[0] == "d" and (c[1][0], ) not in [(r[0],) for r in expected])
    write(frame(spark, ("c", None, (gone[1][0], "late"), gone[3] - 1000)), 99, path)
    assert rows(store.read_table(spark, path)) == expected


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write(frame(spark, *[("c", None, (i, "a"), i) for i in range(40)]), 0, path, merge_after=1)
    bucket = {r.id: r.b for r in spark.range(40).withColumn("b", store.bucket_of(["id"], 4)).collect()}
    was = files(path)
    time.sleep(0.01)
    write(frame(spark, ("u", (3, "a"), (3, "b"), 100)), 1, path, merge_after=1)
    now = files(path)
    assert was.items() <= now.items()
    assert {f.split("bucket=")[1].split("/")[0] for f in now.keys() - was.keys()} == {str(bucket[3])}
    manifest = store.read_manifest(spark, path)
    assert {b for b, p in manifest.parts.items() if p == ["v=0"]} == set(bucket.values()) - {bucket[3]}
    # merging, too, writes crowded buckets only
    write(frame(spark, ("u", (3, "b"), (3, "c"), 101)), 2, path, merge_after=9)
    was = files(path)
    assert store.merge_parts(spark, path) == 1 and was.items() <= files(path).items()
    store.drop_replaced(spark, path)
    left = {f.split("/data/")[1].split("/")[0] for f in files(path)}
    assert left == {"v=0", "v=3-merged"}
    assert dict(rows(store.read_table(spark, path)))[3] == "c"


def test_a_read_looks_at_named_parts_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        write(frame(spark, ("c", None, (1, f"v{i}"), i)), i, path, merge_after=1)
    # batches that are replaced may be gone, and nothing lists them
    for i in range(4):
        os.rename(f"{path}/data/v={i}", f"{path}/data/old-{i}")
    table = store.read_table(spark, path)
    assert rows(table) == [(1, "v4")]
    assert all("/v=4-merged/" in f for f in table.inputFiles()) and "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_keys_are_read_from_their_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    write(frame(spark, *[("c", None, (i, f"v{i}"), i) for i in range(40)], ("d", (8, "x"), None, 90)), 0, path, buckets=16)
    got = store.read_keys(spark, path, spark.createDataFrame([(7,), (8,), (77,)], "id INT"))
    assert rows(got) == [(7, "v7")]
    assert len({f.split("bucket=")[1].split("/")[0] for f in got.inputFiles()}) <= 3


def test_a_version_cut_off_before_it_was_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write(frame(spark, ("c", None, (1, "a"), 1)), 0, path)
    with monkeypatch.context() as patched:
        patched.setattr(store, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError, match="cut off"):
            write(frame(spark, ("c", None, (2, "b"), 2)), 1, path)
    assert rows(store.read_table(spark, path)) == [(1, "a")]
    write(frame(spark, ("c", None, (2, "b"), 2)), 1, path)
    assert rows(store.read_table(spark, path)) == [(1, "a"), (2, "b")]
    # two jobs cannot publish the same version
    old = store.read_manifest(spark, path)
    with pytest.raises(RuntimeError, match="another job"):
        store.publish(spark, path, old)


def test_streams_and_checkpoints(spark, tmp_path):
    path, source = str(tmp_path / "t"), str(tmp_path / "in")
    changes = random_changes(5)
    frame(spark, *changes).repartition(4).write.parquet(source)
    stream = spark.readStream.schema(frame(spark, changes[0]).schema).option("maxFilesPerTrigger", 1).parquet(source)
    store.start_apply(stream, path, KEYS, ORDER, buckets=3, merge_after=2).awaitTermination()
    expected = applied(frame(spark, *changes))
    assert rows(store.read_table(spark, path)) == expected
    assert store.read_manifest(spark, path).batch == 3
    with pytest.raises(ValueError, match="another checkpoint"):
        store.start_apply(stream, path, KEYS, ORDER, checkpoint=str(tmp_path / "other"))
    store.start_apply(stream, path, KEYS, ORDER).awaitTermination()
    assert rows(store.read_table(spark, path)) == expected


def test_empty_batches_and_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no finished batch"):
        store.read_table(spark, path)
    write(frame(spark, ("c", None, (1, "a"), 1)).limit(0), 0, path)
    assert rows(store.read_table(spark, path)) == [] and store.read_manifest(spark, path).batch == 0
    write(frame(spark, ("c", None, (1, "a"), 1)), 1, path)
    assert rows(store.read_table(spark, path)) == [(1, "a")]


IMAGES = {"shop.a": "id BIGINT, name STRING", "shop.b": "k1 STRING, k2 INT, at TIMESTAMP"}
TABLE_KEYS = {"shop.a": ["id"], "shop.b": ["k1", "k2"]}


def texts(spark, table, ddl, *changes):
    image = f"STRUCT<{ddl}>"
    df = spark.createDataFrame(
        [(b, a, ("shop", table, 1, pos), op, 1, None) for op, b, a, pos in changes],
        f"before {image}, after {image}, source STRUCT<db: STRING, table: STRING, ts_ms: BIGINT, pos: BIGINT>, op STRING, ts_ms BIGINT, transaction STRING",
    )
    return normalize_envelope(df).select("value")


def test_many_tables_in_one_stream(spark, tmp_path):
    import datetime as dt

    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    lines, path = str(tmp_path / "lines"), str(tmp_path / "t")
    source = "db STRING, table STRING, ts_ms BIGINT, pos BIGINT"

    def run(images, keys):
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(lines)
        mirror.start_mirror_tables(stream, path, images, keys, ["source.pos"], source, buckets=2, merge_after=1).awaitTermination()

    a = texts(spark, "a", IMAGES["shop.a"], ("c", None, (1, "x"), 1), ("u", (1, "x"), (2, "y"), 2), ("c", None, (3, "z"), 3), ("d", (3, "z"), None, 9))
    b = texts(spark, "b", IMAGES["shop.b"], ("c", None, ("p", None, at), 4), ("c", None, ("p", 1, at), 5), ("u", ("p", 1, at), ("p", 1, None), 6))
    a.union(b).repartition(3).write.text(lines)
    run(IMAGES, TABLE_KEYS)
    assert rows(mirror.read_mirrored(spark, path, "shop.a")) == [(2, "y")]
    assert sorted(map(tuple, mirror.read_mirrored(spark, path, "shop.b").collect()), key=repr) == [("p", 1, None), ("p", None, at)]
    # a table and a column more
    images = {"shop.a": "id BIGINT, name STRING, extra INT", "shop.b": IMAGES["shop.b"], "shop.c": "n INT"}
    more = texts(spark, "c", "n INT", ("c", None, (5,), 10)).union(texts(spark, "a", images["shop.a"], ("c", None, (4, "w", 8), 11)))
    more.coalesce(1).write.mode("append").text(lines)
    run(images, TABLE_KEYS | {"shop.c": ["n"]})
    assert rows(mirror.read_mirrored(spark, path, "shop.c")) == [(5,)]
    assert sorted(map(tuple, mirror.read_mirrored(spark, path, "shop.a").collect())) == [(2, "y", None), (4, "w", 8)]
    assert mirror.read_mirrored(spark, path, "shop.b").count() == 2
    with pytest.raises(ValueError, match="no table shop.z"):
        mirror.read_mirrored(spark, path, "shop.z")
    with pytest.raises(ValueError, match="same tables"):
        mirror.start_mirror_tables(a, path, IMAGES, {"shop.a": ["id"]}, ["source.pos"])
