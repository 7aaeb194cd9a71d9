import json
import os

from tests.test_changelog import frame
from tideline.operators.changelog import to_row_kinds
from tideline.plans.publish import publish_by_key, publish_by_registry
from tideline.model import REGISTRY_SCHEMA
from tideline.sinks.debug import debug_lines, debug_sink, read_debug
from tideline.sinks.rows import delete_statement, encode_rows, write_rows
from tideline.sinks.topics import in_order, ordered_frame, sink_options, topic_frame


def changes(spark):
    return frame(spark, ("c", None, (1, None), 1), ("u", (1, None), (1, "b"), 2), ("d", (1, "b"), None, 3))


def test_encode_and_write_rows(spark, tmp_path):
    kinds = to_row_kinds(changes(spark))
    lines = [json.loads(r.line) for r in encode_rows(kinds).collect()]
    assert lines == [{"id": 1, "v": None}, {"id": 1, "v": "b"}]
    write_rows(kinds, str(tmp_path / "rows"))
    write_rows(kinds, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows")).count() == 4


def test_timestamps_as_sql_text(spark):
    rows = spark.sql(
        "SELECT '+I' AS row_kind, TIMESTAMP_NTZ'2024-01-01 10:00:00' AS a, TIMESTAMP_NTZ'2024-01-01 10:00:00.120' AS b,"
        " TIMESTAMP'2024-01-01 10:00:00+02:00' AS c, DATE'2024-01-02' AS d"
    )
    assert json.loads(encode_rows(rows).first().line) == {
        "a": "2024-01-01 10:00:00",
        "b": "2024-01-01 10:00:00.12",
        "c": "2024-01-01 08:00:00Z",
        "d": "2024-01-02",
    }


def test_topic_frame(spark):
    out = publish_by_key(changes(spark), {"d.t": "id"}, 4)
    assert out.dtypes == [("value", "string"), ("partition", "int")]
    assert len({r.partition for r in out.collect()}) == 1
    assert topic_frame(out.select("value")).columns == ["value"]
    registry = spark.createDataFrame([("d.t", "3", "x")], REGISTRY_SCHEMA)
    assert {r.partition for r in publish_by_registry(changes(spark), registry, "x").collect()} == {3}


def test_sink_options():
    assert sink_options("h:1", "t", {"acks": "all", "kafka.linger.ms": "5"}) == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "t",
        "kafka.acks": "all",
        "kafka.linger.ms": "5",
    }


def test_delete_statement():
    assert delete_statement("db.t", ["id"], "db.s") == "DELETE FROM db.t WHERE id IN (SELECT id FROM db.s)"
    assert delete_statement("db.t", ["a", "b"], "db.s", mutation=True) == (
        "ALTER TABLE db.t DELETE WHERE (a, b) IN (SELECT a, b FROM db.s)"
    )


def test_debug(spark, tmp_path):
    kinds = to_row_kinds(changes(spark), ["pos"])
    lines = {(r.pos, r.line) for r in debug_lines(kinds, ["pos"]).collect()}
    assert lines == {(1, "+I[1, null]"), (2, "-U[1, null]"), (2, "+U[1, b]"), (3, "-D[1, b]")}
    many = spark.range(50).selectExpr("'+I' AS row_kind", "id")
    debug_sink(many, str(tmp_path / "lines"))
    got = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert sorted(got) == sorted(f"+I[{i}]" for i in range(50))


def test_debug_in_order(spark, tmp_path):
    rows = spark.range(3000).selectExpr("'+I' AS row_kind", "(id * 7919) % 3000 AS id", "(id * 7919) % 3000 AS at")
    path = str(tmp_path / "lines")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        debug_sink(rows.repartition(16), path, ["at"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(names) > 1
    written = [line for name in names for line in open(os.path.join(path, name)).read().splitlines()]
    assert written == [f"+I[{i}]" for i in range(3000)]
    got = sorted((r.position, r.line) for r in read_debug(spark, path).collect())
    assert got == list(enumerate(written))
    debug_sink(rows.limit(0), str(tmp_path / "none"), ["at"])
    assert read_debug(spark, str(tmp_path / "none")).collect() == []


def routed(spark, n=2000):
    # a third of all rows in partition 1; some rows have none
    part = "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 5 AS INT) END AS partition"
    return spark.range(n).selectExpr("CAST(id AS STRING) AS value", part, f"(id * 7919) % {n} AS at").repartition(8)


def test_ordered_frame(spark):
    rows = routed(spark)
    wanted = {}
    for r in sorted(rows.collect(), key=lambda r: r.at):
        wanted.setdefault(r.partition, []).append(r.value)
    got = {}
    for r in sorted(ordered_frame(rows, ["at"]).collect(), key=lambda r: r.sequence):
        assert r.sequence == len(got.setdefault(r.partition, []))
        got[r.partition].append(r.value)
    assert got == wanted
    assert ordered_frame(rows.limit(0), ["at"]).collect() == []


def test_topic_partitions_stay_in_a_task(spark):
    sent = in_order(routed(spark), ["at"], 5)
    assert sent.columns == ["value", "partition"]
    at = {r.value: r.at for r in routed(spark).collect()}
    tasks = {}
    for r in sent.selectExpr("*", "spark_partition_id() AS task").collect():
        tasks.setdefault(r.partition, []).append((r.task, at[r.value]))
    for rows in tasks.values():
        assert len({task for task, _ in rows}) == 1
        assert [at for _, at in rows] == sorted(at for _, at in rows)
