import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.test_changelog import frame
from tideline.functions.hashing import string_hash
from tideline.model import REGISTRY_SCHEMA
from tideline.operators.positions import with_position
from tideline.operators.routing import (
    allocate_partitions,
    hash_partition,
    partition_load,
    registry_for,
    registry_partition,
)


def java_hash(text):
    h = 0
    units = text.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def check_hashes(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s STRING")
    got = df.select("s", string_hash(F.col("s")).alias("h")).collect()
    assert [(r.s, r.h) for r in got] == [(t, java_hash(t)) for t in texts]


def test_known_hashes(spark):
    # "polygenelubricants" hashes to the smallest int
    check_hashes(spark, ["", "a", "hello", "polygenelubricants", "表格shop", "😀", "a😀é中b" * 9])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), min_size=1, max_size=20))
def test_any_hash(spark, texts):
    check_hashes(spark, texts)


def test_hash_partition(spark):
    tables = [("d", "t"), (" d ", " t "), ("商店", "表😀"), ("d", "unknown"), ("a.b", "c")]
    changes, expected = [], {}
    for i in range(40):
        db, table = tables[i % 5]
        image = (i * 7919, "v")
        changes.append(("d", image, None, i, db, table) if i % 3 == 0 else ("c", None, image, i, db, table))
        key = str(i * 7919) if (db.strip(), table.strip()) in (("d", "t"), ("商店", "表😀"), ("a.b", "c")) else ""
        h = java_hash(table + db + key)
        expected[i] = abs(h) % 11 if h >= 0 else abs(-(abs(h) % 11))
    keys = {"d.t": "id", "商店.表😀": "id", "a.b.c": "id"}
    got = {r.pos: r.partition for r in hash_partition(frame(spark, *changes), keys, 11).collect()}
    assert got == expected


REGISTRY = [("d.t", "2", "one"), ("d.t", "3", "one"), ("d.u", "0", "one"), ("d.t", "5", "two"), (None, "1", "one"), ("d.x", None, "one")]


def registry(spark, rows):
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def test_registry_for(spark):
    got = registry_for(registry(spark, REGISTRY), "one")
    assert sorted(tuple(r) for r in got.collect()) == [("d.t", 2), ("d.u", 0)]


def test_registry_partition(spark):
    routes = registry_for(registry(spark, REGISTRY), "one")
    env = frame(spark, ("c", None, (1, "a"), 1), ("c", None, (1, "a"), 2, " d", "u "))
    assert {r.pos: r.partition for r in registry_partition(env, routes).collect()} == {1: 2, 2: 0}
    missing = frame(spark, ("c", None, (1, "a"), 1, "d", "new"))
    assert registry_partition(missing, routes, "null").first().partition is None
    with pytest.raises(PySparkException, match="no partition registered for d.new"):
        registry_partition(missing, routes).collect()
    with pytest.raises(ValueError):
        registry_partition(missing, routes, "skip")


def test_partition_load(spark):
    routes = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2), ("d", 9)], "db_table_name STRING, partition INT")
    assert {r.partition: r.tables for r in partition_load(routes, 4).collect()} == {0: 2, 1: 0, 2: 1, 3: 0}


def greedy(loads, names, n):
    """One table at a time on the least-loaded partition."""
    loads, out = list(loads), {}
    for name in names:
        p = min(range(n), key=lambda i: (loads[i], i))
        loads[p] += 1
        out[name] = p
    return out


@pytest.mark.parametrize("seed", range(6))
def test_allocation_equals_one_by_one(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([2, 3, 6, 7])
    rows, loads = [], [0] * n
    for i in range(rnd.choice([0, 3, 25])):
        p = min(int(rnd.expovariate(0.7)), n - 1)
        loads[p] += 1
        rows.append((f"old.t{i}", str(p), "topic"))
    rows.append(("old.elsewhere", "0", "other"))
    names = [f"new.t{i}" for i in range(rnd.choice([1, 5, 60]))]
    rnd.shuffle(names)
    given_names = [(f" {name} ", i) for i, name in enumerate(names)] + [(names[0], 999), ("old.t0", 1000)]
    known = {r[0] for r in rows if r[2] == "topic"}
    expected = greedy(loads, [x for x in names + ["old.t0"] if x not in known], n)
    tables = spark.createDataFrame(given_names, "db_table_name STRING, ord BIGINT").repartition(5)
    result = allocate_partitions(registry(spark, rows), tables, "topic", n).collect()
    assert len(result) == len(rows) + len(expected)
    added = {r.db_table_name: int(r.kafka_partition) for r in result if r.db_table_name in expected}
    assert added == expected


def test_nothing_new_to_allocate(spark):
    tables = spark.createDataFrame([("d.t", 1)], "db_table_name STRING, ord BIGINT")
    rows = [("d.t", "2", "topic")]
    assert [tuple(r) for r in allocate_partitions(registry(spark, rows), tables, "topic", 3).collect()] == rows


def test_single_partition(spark):
    tables = spark.createDataFrame([("a.b", 1), ("a.c", 2)], "db_table_name STRING, ord BIGINT")
    got = allocate_partitions(registry(spark, []), tables, "t", 1).collect()
    assert sorted(tuple(r) for r in got) == [("a.b", "0", "t"), ("a.c", "0", "t")]


def test_positions_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(9)
    rows = with_position(df, ["x"]).collect()
    assert [r.position for r in sorted(rows, key=lambda r: r.x)] == list(range(5000))


@pytest.mark.parametrize("small", [True, False])
def test_allocation_over_distinct_loads(spark, monkeypatch, small):
    from tideline.operators import routing

    if not small:
        monkeypatch.setattr(routing, "BROADCAST_ROWS", 10)
    rnd = random.Random(3)
    loads = list(range(0, 240, 2))
    rnd.shuffle(loads)
    taken = [(f"old.t{p}_{k}", str(p), "tp") for p, load in enumerate(loads) for k in range(load)]
    names = [(f"new.t{k}", k) for k in range(700)] + [("old.t3_0", 5), (" new.t7 ", 999)]
    registry = spark.createDataFrame(taken, REGISTRY_SCHEMA)
    out = allocate_partitions(registry, spark.createDataFrame(names, "db_table_name STRING, ord BIGINT"), "tp", len(loads))
    expected = {}
    for name, _ in names[:700]:
        p = min(range(len(loads)), key=lambda q: (loads[q], q))
        loads[p] += 1
        expected[name] = str(p)
    assert {r.db_table_name: r.kafka_partition for r in out.collect() if r.db_table_name.startswith("new")} == expected
    assert out.count() == len(taken) + 700


def test_a_handful_of_tables_takes_few_jobs(spark):
    registry = spark.createDataFrame([("s.a", "0", "tp"), ("s.b", "1", "tp")], REGISTRY_SCHEMA)
    tables = spark.createDataFrame([(f"s.{c}", i) for i, c in enumerate("acdef")], "db_table_name STRING, ord BIGINT")
    spark.sparkContext.setJobGroup("allocate", "few jobs")
    try:
        out = allocate_partitions(registry, tables, "tp", 3)
        assert {r.db_table_name: r.kafka_partition for r in out.collect()} == {"s.a": "0", "s.b": "1", "s.c": "2", "s.d": "0", "s.e": "1", "s.f": "2"}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("allocate")) <= 10
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
