"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tideline.plans.registered import QUERIES
from tests.test_changelog import applied, frame
from tideline.operators.changelog import apply_changelog, changed_keys
from tideline.operators.routing import hash_partition, registry_partition
from tideline.operators.sizing import checked_broadcast
from tideline.plans import fixtures as fx
from tideline.sources.topics import offsets_for_times, replay_from

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def read_schemas(df):
    return re.findall(r"ReadSchema: struct<(.*?)>\n", plan(df))


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.endswith("stream") and not q.startswith(("q1_s", "q2"))))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text


@pytest.mark.parametrize(
    "name",
    "s1_snapshot s2_initial s3_select_tables t1_normalize t2_render_temporal t3_unwrap_payload t4_flatten "
    "t5_effective_key t6_row_kinds p1_hash_partition p2_registry_partition k1_topic_frame k2_encode_rows "
    "k5_debug_lines s8_replay_from".split(),
)
def test_row_wise_operators_do_not_shuffle(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "Exchange" not in text.replace("BroadcastExchange", "")


def test_changed_keys_read_key_fields_only(spark, tmp_path):
    frame(spark, ("c", None, (1, "a"), 1)).write.parquet(str(tmp_path / "env"))
    env = spark.read.parquet(str(tmp_path / "env"))
    [schema] = read_schemas(changed_keys(env, ["id"]))
    assert schema == "before:struct<id:bigint>,after:struct<id:bigint>,op:string"


def test_last_images_combine_before_the_shuffle(spark):
    text = plan(queries()["k4_latest_rows"](spark, SF))
    assert "partial_max_by" in text and "Window" not in text


def test_time_filter_reaches_the_scan(spark):
    records = fx.topic_events(spark, SF)
    text = plan(offsets_for_times(records, "2024-01-16 00:00:00", {fx.TOPIC: 6}))
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in text
    text = plan(replay_from(records, "2024-01-16 00:00:00"))
    assert "GreaterThanOrEqual(event_id," in text and "Join" not in text


def test_table_selection_reaches_the_scan(spark, tmp_path):
    frame(spark, ("c", None, (1, "a"), 1)).write.parquet(str(tmp_path / "env"))
    from tideline.sources.cdc import select_tables

    text = plan(select_tables(spark.read.parquet(str(tmp_path / "env")), "d").select("pos"))
    assert "EqualTo(source.db,d)" in text
    assert "source:struct<db:string>" in text


def test_fan_out_rebalances(spark):
    env = frame(spark, ("c", None, (1, "a"), 1))
    rows = env.withColumns({"db": F.col("source.db"), "table": F.col("source.table")})
    text = plan(rows.hint("rebalance", F.col("db"), F.col("table")))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_checked_broadcast(spark):
    side = spark.range(10)
    assert "BroadcastHashJoin" in plan(spark.range(100).join(checked_broadcast(side, 10), "id"))
    assert checked_broadcast(side, 9) is side


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    """Too many tables for a broadcast: the same rows by a shuffled join."""
    from tideline.operators import changelog, routing

    env = frame(spark, *[("c", None, (i, "a"), i, "d", f"t{i % 3}") for i in range(30)])
    keys = {f"d.t{i}": "id" for i in range(3)}
    routes = spark.createDataFrame([(f"d.t{i}", i) for i in range(3)], "db_table_name STRING, partition INT")

    def both():
        a = sorted((r.pos, r.partition) for r in hash_partition(env, keys, 5).collect())
        b = sorted((r.pos, r.partition) for r in registry_partition(env, routes).collect())
        return a, b

    small = both()
    for module in (changelog, routing):
        monkeypatch.setattr(module, "checked_broadcast", lambda side, **_: checked_broadcast(side, 0))
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert both() == small
        assert "SortMergeJoin" in plan(registry_partition(env, routes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)


def test_bucketed_base_is_not_shuffled(spark, tmp_path):
    """A base bucketed by key joins in place, however many keys have changed."""
    spark.sql("DROP TABLE IF EXISTS bucketed_base")
    spark.range(100).select("id", F.lit("old").alias("v")).write.bucketBy(8, "id").option(
        "path", str(tmp_path / "base")
    ).saveAsTable("bucketed_base")
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        env = frame(spark, ("u", (1, "old"), (1, "new"), 1), ("d", (2, "old"), None, 2))
        base = spark.table("bucketed_base")
        df = apply_changelog(base, env, ["id"], ["ts_ms", "pos"])
        base_side = plan(df).split("Scan parquet")[0]
        assert "SortMergeJoin LeftAnti" in plan(df)
        # one exchange for the changed keys, one for the images, none for the base
        assert len(re.findall(r"^\(\d+\) Exchange", plan(df), re.MULTILINE)) == 2, base_side
        assert len(applied(env, base)) == 99
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        spark.sql("DROP TABLE bucketed_base")




def test_untouched_compacted_rows_are_not_shuffled(spark, tmp_path):
    from tideline.streaming.apply import compact_applied, read_applied, write_batch

    path = str(tmp_path / "table")
    write_batch(frame(spark, *[("c", None, (i, "a"), i) for i in range(50)]), 0, path, ["id"], ["pos"])
    compact_applied(spark, path, ["id"])
    write_batch(frame(spark, ("u", (7, "a"), (7, "b"), 99), ("d", (8, "a"), None, 100)), 1, path, ["id"], ["pos"])
    rows = read_applied(spark, path, ["id"])
    branches = plan(rows).split("Union", 1)[1]
    untouched = branches[: branches.index("+- *", branches.index("LeftAnti")) if "+- *" in branches else None]
    assert "Exchange hashpartitioning" not in untouched.split("LeftAnti")[0]
    assert {r.id: r.v for r in rows.collect()} == {i: "b" if i == 7 else "a" for i in range(50) if i != 8}
