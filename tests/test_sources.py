import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.test_changelog import frame
from tideline.sources import topics
from tideline.sources.cdc import cdc_snapshot, cdc_source, select_tables
from tideline.sources.jdbc import jdbc_options
from tideline.sources.topics import (
    offsets_for_times,
    replay_from,
    replay_options,
    starting_offsets,
    topic_options,
)


def test_snapshot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id BIGINT, v STRING")
    rows = cdc_snapshot(df, "d", "t", 99, 5).orderBy("after.id").collect()
    assert [(r.op, r.before, r.after.v, r.source.table, r.source.pos, r.ts_ms) for r in rows] == [
        ("r", None, "a", "t", 5, 99),
        ("r", None, "b", "t", 5, 99),
    ]


def test_startup_modes(spark):
    df = spark.createDataFrame([(1, "a")], "id BIGINT, v STRING")
    snapshot = cdc_snapshot(df, "d", "t", 99, 2)
    changes = frame(spark, *[("c", None, (i, "x"), i) for i in range(1, 5)]).drop("pos")
    source = F.struct("source.db", "source.table", "source.ts_ms", F.col("ts_ms").alias("pos"))
    changes = changes.withColumn("source", source)
    assert sorted(r.op for r in cdc_source(snapshot, changes, "initial", 2).collect()) == ["c", "c", "r"]
    assert cdc_source(snapshot, changes, "latest", 2).count() == 2
    assert cdc_source(None, changes).count() == 4
    assert cdc_source(None, changes, "anything else").count() == 4
    with pytest.raises(ValueError):
        cdc_source(snapshot, changes, "initial")


def test_select_tables(spark):
    env = frame(spark, *[("c", None, (1, "a"), i, db, t) for i, (db, t) in enumerate([("d", "t"), ("d", "t2"), ("e", "t")])])

    def positions(*args, **kw):
        return sorted(r.pos for r in select_tables(env, *args, **kw).collect())

    assert positions() == [0, 1, 2]
    assert positions("d") == [0, 1]
    assert positions("d,e", "d.t, e.t") == [0, 2]
    assert positions(["d"], ["e.t"]) == []
    assert positions("d", r"d\.t\d?", patterns=True) == [0, 1]
    assert positions(None, r"d\.t", patterns=True) == [0]


T0 = dt.datetime(2024, 1, 1)


def records(spark):
    rows = []
    for p, minutes in {0: [0, 10, 5, 20], 1: [0, 1], 2: [30]}.items():
        for i, minute in enumerate(minutes):
            rows.append(("topic", p, i * 10, T0 + dt.timedelta(minutes=minute), "v"))
    return spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING")


def test_offsets_for_times(spark):
    t = T0 + dt.timedelta(minutes=5)
    # partition 0 is out of order in time: the earliest offset counts
    assert {r.partition: r.offset for r in offsets_for_times(records(spark), t).collect()} == {0: 10, 1: None, 2: 0}
    listed = offsets_for_times(records(spark), t, {"topic": 5})
    assert {r.partition: r.offset for r in listed.collect()} == {0: 10, 1: None, 2: 0, 3: None, 4: None}
    assert json.loads(starting_offsets(listed, "topic")) == {"topic": {"0": 10, "1": -1, "2": 0, "3": -1, "4": -1}}


@pytest.mark.parametrize("filter_partitions", [64, 1])
def test_replay(spark, monkeypatch, filter_partitions):
    monkeypatch.setattr(topics, "FILTER_PARTITIONS", filter_partitions)
    t = T0 + dt.timedelta(minutes=5)

    def replayed(**kw):
        return sorted((r.partition, r.offset) for r in replay_from(records(spark), t, **kw).collect())

    found = [(0, 10), (0, 20), (0, 30)]
    assert replayed() == found + [(2, 0)]
    assert replayed(unmatched="earliest") == found + [(1, 0), (1, 10), (2, 0)]
    held = spark.createDataFrame([("topic", 1, 10), ("topic", 0, 0)], "topic STRING, partition INT, offset BIGINT")
    assert replayed(committed=held) == found + [(1, 10), (2, 0)]
    # a null position is none
    none = spark.createDataFrame([("topic", 1, None), ("topic", 0, 0)], "topic STRING, partition INT, offset BIGINT")
    assert replayed(committed=none) == found + [(2, 0)]
    assert replayed(committed=none, unmatched="earliest") == found + [(1, 0), (1, 10), (2, 0)]
    assert replay_from(records(spark), t).columns == records(spark).columns
    with pytest.raises(ValueError):
        replayed(unmatched="none")
    late = replay_from(records(spark), T0 + dt.timedelta(days=1))
    assert late.count() == 0
    assert replay_from(records(spark), T0 + dt.timedelta(days=1), "earliest").count() == 7


def test_replay_of_too_many_partitions_for_a_broadcast(spark, monkeypatch):
    t = T0 + dt.timedelta(minutes=5)
    monkeypatch.setattr(topics, "checked_broadcast", lambda side: side)
    got = sorted((r.partition, r.offset) for r in replay_from(records(spark), t).collect())
    assert got == [(0, 10), (0, 20), (0, 30), (2, 0)]


def test_topic_options():
    got = topic_options("h:1", "t", 30, "latest", {"security.protocol": "SASL_SSL", "kafka.x": "y"})
    assert got == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "maxOffsetsPerTrigger": "30",
        "startingOffsets": "latest",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.x": "y",
    }
    since = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    assert replay_options(since) == {
        "startingTimestamp": "1704067200000",
        "startingOffsetsByTimestampStrategy": "latest",
    }
    hour_ago = int(replay_options()["startingTimestamp"]) / 1000
    assert abs(dt.datetime.now().timestamp() - 3600 - hour_ago) < 60


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t", "u", "p")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x", "t", "u", "p", "id", (0, 100), 4)
    assert split["numPartitions"] == "4" and split["upperBound"] == "100" and split["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "u", "p", "id")
