"""The registered queries: one or more per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline import model as m
from tideline.functions.temporal import epoch_micros, render_temporal
from tideline.operators import changelog, envelope, routing
from tideline.plans import fixtures as fx
from tideline.plans.mirror import mirror_table, read_mirrored, start_mirror, start_mirror_tables
from tideline.plans.publish import publish_by_key, publish_by_registry
from tideline.plans.scripts import run_script, start_script
from tideline.session import fresh_path
from tideline.sinks import debug, rows
from tideline.sources import cdc, topics
from tideline.streaming import buckets
from tideline.streaming.apply import compact_applied, read_applied, start_apply, write_batch
from tideline.streaming.commits import read_commits, read_fan_out
from tideline.streaming.jobs import envelope_stream, start_envelope_files, start_fan_out

KEYS = ["user_id"]
ORDER = ["order_ts", "pos"]
TEMPORAL = {"ts": m.TIMESTAMP_US}
TAIL = "2024-01-30 23:00:00"
MIDDLE = "2024-01-16 00:00:00"
SNAPSHOT_POS = 99
# tables 0-2 have the key, 3 names a missing column, 4 is unknown
KEY_MAP = {
    "shop.events_0": "user_id",
    "shop.events_1": "user_id",
    "shop.events_2": "event_id",
    "shop.events_3": "no_such_column",
}



# sources


def s1_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = cdc.cdc_snapshot(fx.table(spark, sf_dir, "orders"), "shop", "orders", fx.SNAPSHOT_TS)
    return env.select(
        "op", F.col("source.db").alias("db"), F.col("source.table").alias("tbl"), "ts_ms",
        F.col("before").isNull().alias("no_before"), "after.*",
    )


def s1_snapshot_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = cdc.cdc_snapshot(fx.table(spark, sf_dir, "orders"), "shop", "orders", fx.SNAPSHOT_TS, SNAPSHOT_POS)
    return envelope.normalize_envelope(env).select(F.col("after.o_orderkey").alias("o_orderkey"), "value")


def _user_source(spark: SparkSession, sf_dir: str, startup: str) -> DataFrame:
    snapshot = cdc.cdc_snapshot(fx.user_rows(spark, sf_dir), fx.DB, "users", fx.SNAPSHOT_TS, SNAPSHOT_POS)
    changes = fx.cdc_events(spark, sf_dir).drop("order_ts", "pos")
    env = cdc.cdc_source(snapshot, changes, startup, SNAPSHOT_POS)
    return env.select(
        "op", F.col("source.table").alias("tbl"), F.col("source.pos").alias("pos"), "ts_ms",
        F.coalesce("after.user_id", "before.user_id").alias("user_id"), *_both_images(),
    )


def _both_images(root: str = "") -> list[Column]:
    """All fields of both images, named ``b_…`` and ``a_…``."""
    names = StructType.fromDDL(fx.IMAGE).names
    return [F.col(f"{root}{side}.{name}").alias(f"{side[0]}_{name}") for side in ("before", "after") for name in names]


def s2_initial(spark, sf_dir):
    return _user_source(spark, sf_dir, "initial")


def s2_latest(spark, sf_dir):
    return _user_source(spark, sf_dir, "latest")


def s2_initial_stream(spark, sf_dir):
    """A live start from the snapshot: its images, then the changes behind it."""
    path = fresh_path(spark, "initial")
    snapshot = cdc.cdc_snapshot(fx.user_rows(spark, sf_dir), fx.DB, "users", fx.SNAPSHOT_TS, SNAPSHOT_POS)
    changes = _event_stream(spark, sf_dir)
    start_mirror(changes, path, KEYS, ORDER, snapshot, SNAPSHOT_POS, databases=fx.DB).awaitTermination()
    return read_applied(spark, path, KEYS)


def s3_select_tables(spark, sf_dir):
    env = cdc.select_tables(fx.cdc_events(spark, sf_dir), "shop", "shop.events_1, shop.events_3")
    return env.select(F.col("source.table").alias("tbl"), "op", "pos")


def s3_select_patterns(spark, sf_dir):
    env = cdc.select_tables(fx.cdc_events(spark, sf_dir), "sh.p", r"shop\.events_[0-2]", patterns=True)
    return env.groupBy(F.col("source.table").alias("tbl"), "op").agg(F.count(F.lit(1)).alias("n"))


def s7_offsets_for_times(spark, sf_dir):
    return topics.offsets_for_times(fx.topic_events(spark, sf_dir), MIDDLE, {fx.TOPIC: 8})


def s7_offsets_tail(spark, sf_dir):
    return topics.offsets_for_times(fx.topic_events(spark, sf_dir), TAIL, {fx.TOPIC: 8})


def s8_replay_from(spark, sf_dir):
    return topics.replay_from(fx.topic_events(spark, sf_dir), MIDDLE)


def s8_replay_earliest(spark, sf_dir):
    return topics.replay_from(fx.topic_events(spark, sf_dir), TAIL, unmatched="earliest")


# envelopes


def t1_normalize(spark, sf_dir):
    env = fx.cdc_events(spark, sf_dir, with_nulls=True)
    return envelope.normalize_envelope(env, TEMPORAL).select("pos", "value")


def t1_normalize_mixed(spark, sf_dir):
    """Text images of two tables in which ``at`` differs in its logical type; every seventh ``note`` is null."""
    events = fx.event_rows(fx.table(spark, sf_dir, "events"))
    days = F.col("event_id") % 2 == 0
    at = F.when(days, F.call_function("div", F.col("ts"), F.lit(86_400_000_000))).otherwise(F.call_function("div", F.col("ts"), F.lit(1_000_000)) * 1000)
    note = F.when(F.col("event_id") % 7 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    env = events.select(
        F.lit(None).cast("string").alias("before"),
        F.concat(F.lit('{"at":'), at.cast("string"), F.lit(',"id":'), "event_id", F.lit(',"note":'), note, F.lit("}")).alias("after"),
        F.struct(F.lit("shop").alias("db"), F.when(days, "days").otherwise("moments").alias("table")).alias("source"),
        F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("ts_ms"), F.lit(None).cast("string").alias("transaction"),
        F.col("event_id").alias("pos"),
    )
    return envelope.normalize_envelope(env, {"shop.days": {"at": m.DATE}, "at": m.TIMESTAMP_MS}).select("pos", "value")


def t2_render_temporal(spark, sf_dir):
    events = fx.event_rows(fx.table(spark, sf_dir, "events").withColumn("utc", F.col("ts")))
    us = F.col("ts")
    ms = F.call_function("div", us, F.lit(1000))
    day_us = us % 86_400_000_000
    iso = F.replace(F.col("utc").cast("string"), F.lit(" "), F.lit("T"))
    zoned = F.concat(iso, F.lit("Z"))
    return events.select(
        "event_id",
        render_temporal(F.call_function("div", us, F.lit(86_400_000_000)), m.DATE).alias("as_date"),
        render_temporal(F.call_function("div", day_us, F.lit(1000)), m.TIME_MS).alias("time_ms"),
        render_temporal(day_us, m.TIME_US).alias("time_us"),
        render_temporal(day_us - day_us % 60_000_000, m.TIME_US).alias("time_whole_minute"),
        render_temporal(day_us * 1000, m.TIME_NS).alias("time_ns"),
        render_temporal(ms, m.TIMESTAMP_MS).alias("ts_ms_text"),
        render_temporal(ms, m.TIMESTAMP_MS, compat=True).alias("ts_ms_compat"),
        render_temporal(ms - ms % 1000, m.TIMESTAMP_MS).alias("ts_whole_second"),
        render_temporal(us, m.TIMESTAMP_US).alias("ts_us_text"),
        render_temporal((us - us % 1_000_000) * 1000, m.TIMESTAMP_NS).alias("ts_ns_whole"),
        render_temporal(zoned, m.ZONED).alias("zoned_text"),
    )


def t2_order_dates(spark, sf_dir):
    day = F.unix_date(F.to_date("o_orderdate"))
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        render_temporal(day, m.DATE, source_type="int").alias("day_text"),
        render_temporal(day.cast("bigint") * 86_400_000, m.TIMESTAMP_MS).alias("ts_text"),
    )


def _envelope_texts(spark, sf_dir, with_nulls=False):
    return envelope.normalize_envelope(fx.cdc_events(spark, sf_dir, with_nulls)).select("pos", "value")


def _half_wrapped(texts: DataFrame) -> DataFrame:
    wrapped = F.concat(F.lit('{"schema":{},"payload":'), F.col("value"), F.lit("}"))
    return texts.withColumn("value", F.when(F.col("pos") % 2 == 0, wrapped).otherwise(F.col("value")))


def t3_unwrap_payload(spark, sf_dir):
    texts = envelope.unwrap_payload(_half_wrapped(_envelope_texts(spark, sf_dir)))
    image, source = (", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl).fields) for ddl in (fx.IMAGE, fx.SOURCE))
    shape = f"op STRING, ts_ms BIGINT, transaction STRING, source STRUCT<{source}>, before STRUCT<{image}>, after STRUCT<{image}>, payload STRING"
    return texts.select("pos", F.from_json("value", shape).alias("e")).select(
        "pos",
        "e.op",
        "e.ts_ms",
        F.col("e.transaction").alias("tx"),
        F.col("e.source.table").alias("tbl"),
        F.col("e.source.db").alias("db"),
        F.col("e.source.ts_ms").alias("source_ts_ms"),
        F.col("e.source.pos").alias("source_pos"),
        *_both_images("e."),
        F.col("e.payload").isNull().alias("bare"),
    )


def t4_flatten(spark, sf_dir):
    return envelope.flatten_changes(_half_wrapped(_envelope_texts(spark, sf_dir, True)), fx.IMAGE).withColumnRenamed(
        "table", "tbl"
    )


def t4_flatten_decimals(spark, sf_dir):
    """Amounts of 38 digits in envelope text, every fifth one written as ``""``."""
    whole = F.concat(F.lit("9876543210"), F.lpad(F.col("event_id").cast("string"), 10, "0"))
    part = F.concat(F.lpad(F.col("user_id").cast("string"), 12, "0"), F.lit("123456"))
    amount = F.when(F.col("event_id") % 5 == 0, F.lit('""')).otherwise(F.concat(whole, F.lit("."), part))
    text = F.concat(
        F.lit('{"before":{},"after":{"event_id":'), "event_id", F.lit(',"amount":'), amount,
        F.lit('},"source":{"db":"shop","table":"amounts"},"op":"c","ts_ms":1}'),
    )
    texts = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), text.alias("value"))
    rows = envelope.flatten_changes(_half_wrapped(texts), "event_id BIGINT, amount DECIMAL(38,18)")
    return rows.select("event_id", F.col("amount").cast("string").alias("amount"))


def t4_flatten_types(spark, sf_dir):
    """Binary, instant, local, array and large decimal columns, through envelope text and back.

    Local times are shown to the millisecond, as those of a log are; instants to the microsecond.
    """
    events = fx.table(spark, sf_dir, "events")
    row = events.select(
        "event_id",
        F.col("props").cast("binary").alias("raw"),
        F.when(F.col("event_id") % 6 != 0, F.timestamp_micros(epoch_micros(F.col("ts")))).alias("moment"),
        F.col("ts").alias("local"),
        F.to_date("ts").alias("day"),
        F.array(F.col("user_id"), F.col("event_id")).alias("ids"),
        (F.col("user_id").cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col("event_id")).cast("decimal(38,0)").alias("big"),
    )
    texts = envelope.normalize_envelope(cdc.cdc_snapshot(row, "shop", "typed", fx.SNAPSHOT_TS)).select(F.col("after.event_id").alias("pos"), "value")
    back = envelope.flatten_changes(_half_wrapped(texts), row.schema)
    return back.select(
        "event_id", F.hex("raw").alias("raw"), F.unix_micros("moment").alias("moment"), F.col("local").cast("string").alias("local"),
        F.col("day").cast("string").alias("day"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.col("big").cast("string").alias("big"),
    )


def t5_effective_key(spark, sf_dir):
    return changelog.effective_key(fx.cdc_events(spark, sf_dir), KEY_MAP).select("pos", "op", "key_value")


def t6_row_kinds(spark, sf_dir):
    return changelog.to_row_kinds(fx.cdc_events(spark, sf_dir), ["pos"])


def t7_primary_key_map(spark, sf_dir):
    return changelog.primary_key_map(fx.part_descriptions(spark, sf_dir))


def t8_fan_out(spark, sf_dir):
    path = fresh_path(spark, "fan-out")
    env = fx.cdc_events(spark, sf_dir)
    changelog.fan_out(env, path, ["shop.events_0", "shop.events_3"])
    changelog.fan_out(env, path, ["shop.events_1", "shop.events_2", "shop.events_4"])
    return (
        spark.read.parquet(path)
        .groupBy("db", F.col("table").alias("tbl"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    )


def t8_fan_out_stream(spark, sf_dir):
    """The fan-out of a stream, read back by its commits while a later batch is unfinished."""
    path = fresh_path(spark, "fan-out")
    start_fan_out(_event_stream(spark, sf_dir), path, f"{path}-checkpoint").awaitTermination()
    unfinished = read_commits(spark, path).last + 1
    changelog.fan_out(fx.cdc_events(spark, sf_dir).filter("pos % 2 = 0"), f"{path}/batch_id={unfinished}", ["shop.events_1"])
    return (
        read_fan_out(spark, path)
        .groupBy("db", F.col("table").alias("tbl"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    )


# routing


def p1_hash_partition(spark, sf_dir):
    env = routing.hash_partition(fx.cdc_events(spark, sf_dir), KEY_MAP, 7)
    return env.select("pos", "key_value", "partition")


def p1_hash_temporal_key(spark, sf_dir):
    """Keyed by a timestamp, as the envelope writes it."""
    keys = {f"shop.events_{i}": "ts" if i < 3 else "event_type" for i in range(5)}
    env = envelope.image_texts(fx.cdc_events(spark, sf_dir), TEMPORAL)
    return routing.hash_partition(env, keys, 97).select("pos", "key_value", "partition")


def p2_registry_partition(spark, sf_dir):
    env = fx.cdc_events(spark, sf_dir)
    registry = routing.allocate_partitions(fx.empty_registry(spark), fx.event_tables(env), fx.TOPIC, 3)
    routed = routing.registry_partition(env, routing.registry_for(registry, fx.TOPIC))
    return routed.select("pos", F.col("source.table").alias("tbl"), "partition")


def p3_partition_load(spark, sf_dir):
    return routing.partition_load(routing.registry_for(fx.supplier_registry(spark, sf_dir), fx.TOPIC), 12)


def p4_allocate(spark, sf_dir):
    return routing.allocate_partitions(
        fx.supplier_registry(spark, sf_dir), fx.customer_tables(spark, sf_dir), fx.TOPIC, 12
    )


def p4_allocate_empty(spark, sf_dir):
    return routing.allocate_partitions(fx.empty_registry(spark), fx.customer_tables(spark, sf_dir), fx.TOPIC, 6)


def p4_allocate_wide(spark, sf_dir):
    """A topic of 5,000 partitions with many different loads."""
    return routing.allocate_partitions(fx.wide_registry(spark, sf_dir), fx.customer_tables(spark, sf_dir), fx.TOPIC, 5_000)


def p5_registry_for(spark, sf_dir):
    return routing.registry_for(fx.supplier_registry(spark, sf_dir), "audit")


# sinks


def k1_topic_frame(spark, sf_dir):
    return publish_by_key(fx.cdc_events(spark, sf_dir), KEY_MAP, 6, TEMPORAL)


def k1_ordered_frame(spark, sf_dir):
    return publish_by_key(fx.cdc_events(spark, sf_dir), KEY_MAP, 6, TEMPORAL, order_by=["pos"])


def k1_registry_topic_frame(spark, sf_dir):
    env = fx.cdc_events(spark, sf_dir)
    registry = routing.allocate_partitions(fx.supplier_registry(spark, sf_dir), fx.event_tables(env), fx.TOPIC, 12)
    return publish_by_registry(env, registry, fx.TOPIC, TEMPORAL)


def k2_encode_rows(spark, sf_dir):
    kinds = changelog.to_row_kinds(fx.cdc_events(spark, sf_dir, with_nulls=True))
    return rows.encode_rows(kinds)


def k2_encode_orders(spark, sf_dir):
    env = cdc.cdc_snapshot(fx.table(spark, sf_dir, "orders"), "shop", "orders", fx.SNAPSHOT_TS)
    return rows.encode_rows(changelog.to_row_kinds(env))


def k3_delete_keys(spark, sf_dir):
    return changelog.delete_keys(changelog.to_row_kinds(fx.cdc_events(spark, sf_dir)))


def k3_delete_event_keys(spark, sf_dir):
    return changelog.delete_keys(changelog.to_row_kinds(fx.cdc_events(spark, sf_dir)), "event_id")


def k3_remove_rows(spark, sf_dir):
    keys = changelog.delete_keys(changelog.to_row_kinds(fx.cdc_events(spark, sf_dir)))
    return changelog.remove_rows(fx.user_rows(spark, sf_dir), keys)


def k4_latest_rows(spark, sf_dir):
    return changelog.apply_changelog(None, fx.cdc_events(spark, sf_dir), KEYS, ORDER)


def k4_apply_to_base(spark, sf_dir):
    return changelog.apply_changelog(fx.user_rows(spark, sf_dir), fx.cdc_events(spark, sf_dir), KEYS, ORDER)


def k4_moving_keys(spark, sf_dir):
    """Keyed by event id, which every update changes."""
    return changelog.apply_changelog(None, fx.cdc_events(spark, sf_dir), ["event_id"], ORDER)


def _event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return fx.changes_of(fx.event_rows(stream))


def k4_apply_stream(spark, sf_dir):
    path = fresh_path(spark, "applied")
    # every fourth event comes only after the compaction
    first, later = _event_stream(spark, sf_dir).filter("pos % 4 <> 0"), _event_stream(spark, sf_dir).filter("pos % 4 = 0")
    start_apply(first, path, KEYS, ORDER).awaitTermination()
    last = compact_applied(spark, path, KEYS)
    query = later.writeStream.foreachBatch(lambda env, i: write_batch(env, last + 1 + i, path, KEYS, ORDER))
    query.option("checkpointLocation", f"{path}/_later").trigger(availableNow=True).start().awaitTermination()
    return read_applied(spark, path, KEYS, fx.user_rows(spark, sf_dir))


def k4_apply_buckets(spark, sf_dir):
    """Batches into a table of buckets that starts from a snapshot; the last of them changes few keys only."""
    path = fresh_path(spark, "buckets")
    snapshot = cdc.cdc_snapshot(fx.user_rows(spark, sf_dir), fx.DB, "users", fx.SNAPSHOT_TS)
    changes = fx.cdc_events(spark, sf_dir)
    buckets.write_base(snapshot, changes, path, KEYS, ORDER, buckets=16)
    for i, part in enumerate(("pos % 3 = 0 AND user_id % 50 <> 7", "pos % 3 <> 0 AND user_id % 50 <> 7", "user_id % 50 = 7")):
        buckets.write_batch(changes.filter(part), i, path, KEYS, ORDER, merge_after=2)
    return buckets.read_table(spark, path)


def k5_debug_lines(spark, sf_dir):
    env = fx.cdc_events(spark, sf_dir)
    return debug.debug_lines(changelog.to_row_kinds(env, ["pos"]), keep=["pos"])


def k5_ordered_lines(spark, sf_dir):
    """Lines written in order and read back; of an update's two rows the old image comes first."""
    path = fresh_path(spark, "debug")
    kinds = changelog.to_row_kinds(fx.cdc_events(spark, sf_dir), ["pos"])
    debug.debug_sink(kinds.withColumn("new", F.col("row_kind") == m.UPDATE_AFTER), path, ["pos", "new"])
    return debug.read_debug(spark, path)


# scripts and copies

SCRIPT = """
-- a comment before a statement; with a delimiter in it
CREATE TEMPORARY VIEW {v}_lineitem USING parquet OPTIONS (path '{sf}/lineitem.parquet');
CREATE TEMPORARY VIEW {v}_orders USING parquet OPTIONS (path '{sf}/orders.parquet');
CREATE TABLE {v} (flag STRING, note STRING, n BIGINT, quantity DOUBLE) USING parquet LOCATION '{out}';
Insert Into {v}
  SELECT l_returnflag, 'a;b', count(*), sum(l_quantity) FROM {v}_lineitem GROUP BY l_returnflag;
INSERT INTO {v}
  SELECT o_orderstatus, '--x', count(*), CAST(0 AS DOUBLE) FROM {v}_orders GROUP BY o_orderstatus;
"""


def _script_table(spark, sf_dir, mode):
    name, out = f"script_{mode}", fresh_path(spark, "script")
    for view in (f"{name}_lineitem", f"{name}_orders"):
        spark.catalog.dropTempView(view)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run_script(spark, SCRIPT.format(v=name, sf=sf_dir, out=out), mode=mode)
    return spark.read.parquet(out)


def q1_script_batch(spark, sf_dir):
    return _script_table(spark, sf_dir, "batch")


def q2_script_immediate(spark, sf_dir):
    return _script_table(spark, sf_dir, "immediate")


SHARED_SCRIPT = """
CREATE TABLE {v}_status (status STRING, n BIGINT) USING parquet LOCATION '{out}/status';
CREATE TABLE {v}_large (orderkey BIGINT, price DOUBLE) USING parquet LOCATION '{out}/large';
INSERT INTO {v}_status SELECT o_orderstatus, count(*) FROM {v}_orders GROUP BY o_orderstatus;
INSERT INTO {v}_large SELECT o_orderkey, o_totalprice FROM {v}_orders WHERE o_totalprice > 100000;
INSERT INTO {v}_status SELECT o_orderpriority, count(*) FROM {v}_orders GROUP BY o_orderpriority;
"""


def q1_script_shared(spark, sf_dir):
    """Three inserts into two tables, from one scan of their source."""
    name, out = "script_shared", fresh_path(spark, "script")
    fx.table(spark, sf_dir, "orders").createOrReplaceTempView(f"{name}_orders")
    for t in ("status", "large"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{t}")
    run_script(spark, SHARED_SCRIPT.format(v=name, out=out), parallel=2, share=True)
    status, large = (spark.read.parquet(f"{out}/{t}") for t in ("status", "large"))
    return status.select(F.col("status").alias("what"), "n").union(large.select(F.col("orderkey").cast("string"), F.floor("price")))


STREAM_SCRIPT = """
CREATE TABLE {v}_events (event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE) USING parquet LOCATION '{src}';
CREATE TABLE {v}_types (kind STRING) USING parquet LOCATION '{out}/types';
CREATE TABLE {v}_changes (event_id BIGINT, what STRING, kept BOOLEAN) USING parquet LOCATION '{out}/changes';
CREATE TEMPORARY VIEW {v}_errors AS SELECT event_id, user_id, event_type FROM STREAM {v}_events WHERE event_type = 'error';
INSERT INTO {v}_types SELECT DISTINCT event_type FROM {v}_events;
INSERT INTO {v}_changes SELECT event_id, concat(event_type, '/', user_id), true FROM STREAM {v}_events WHERE event_type <> 'error';
INSERT INTO {v}_changes (what, event_id) SELECT concat('-', event_type), event_id FROM {v}_errors;
"""


def q1_script_stream(spark, sf_dir):
    """Streams over the events, started by a script: two inserts into one table, one over a view of a stream."""
    name, out, src = "script_stream", fresh_path(spark, "script"), fresh_path(spark, "events")
    fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value").write.parquet(src)
    spark.catalog.dropTempView(f"{name}_errors")
    for t in ("events", "types", "changes"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{t}")
    for query in start_script(spark, STREAM_SCRIPT.format(v=name, src=src, out=out), f"{out}/checkpoint"):
        query.awaitTermination()
    types, changes = (spark.table(f"{name}_{t}") for t in ("types", "changes"))
    return changes.union(types.select(F.lit(None).cast("bigint"), "kind", F.lit(None).cast("boolean")))


PASS_THROUGH = {
    # joins, semi and anti joins, aggregation
    "q1_pass_joins": """
        SELECT n.n_name AS nation, count(*) AS orders, CAST(sum(floor(o.o_totalprice)) AS BIGINT) AS whole_price
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
             JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
        GROUP BY n.n_name""",
    # grouping sets, having
    "q1_pass_rollup": """
        SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
        FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus) HAVING count(*) > 1""",
    # windows and top-k
    "q1_pass_window": """
        SELECT l_suppkey, l_orderkey, l_linenumber, CAST(place AS BIGINT) AS place FROM (
          SELECT l_suppkey, l_orderkey, l_linenumber,
                 rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS place
          FROM lineitem) ranked WHERE place <= 3""",
    # set operations and string functions
    "q1_pass_sets": """
        SELECT upper(c_mktsegment) AS word FROM customer
        UNION SELECT o_orderpriority FROM orders
        EXCEPT SELECT p_type FROM part""",
}


def _pass_through(name):
    def run(spark, sf_dir):
        for t in ("orders", "customer", "nation", "lineitem", "part"):
            fx.table(spark, sf_dir, t).createOrReplaceTempView(t)
        view = f"{name}_result"
        run_script(spark, f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {PASS_THROUGH[name]}")
        return spark.table(view)

    return run


def q3_mirror(spark, sf_dir):
    """The flagship: snapshot and changes copied into the sink table."""
    snapshot = cdc.cdc_snapshot(fx.user_rows(spark, sf_dir), fx.DB, "users", fx.SNAPSHOT_TS, SNAPSHOT_POS)
    changes = fx.cdc_events(spark, sf_dir)
    return mirror_table(snapshot, changes, KEYS, ORDER, snapshot_pos=SNAPSHOT_POS, databases=fx.DB)


def q3_mirror_stream(spark, sf_dir):
    """The copy over envelope text: events to lines, lines to the sink table."""
    lines, path = fresh_path(spark, "lines"), fresh_path(spark, "mirror")
    texts = envelope.normalize_envelope(_event_stream(spark, sf_dir))
    start_envelope_files(texts, lines, f"{lines}-checkpoint").awaitTermination()
    changes = envelope_stream(spark, lines, fx.IMAGE, fx.SOURCE)
    changes = changes.withColumns({"order_ts": F.col("source.ts_ms"), "pos": F.col("source.pos")})
    start_mirror(changes, path, KEYS, ORDER).awaitTermination()
    return read_applied(spark, path, KEYS)


#: Columns and key of three tables that have little in common.
MIRRORED = {
    "shop.events": (fx.IMAGE, ["user_id"]),
    "shop.clicks": ("user_id BIGINT, kind STRING", ["user_id"]),
    "crm.amounts": ("uid STRING, amount DECIMAL(38,6), at TIMESTAMP, ids ARRAY<BIGINT>", ["uid"]),
}


def _table_texts(spark, sf_dir):
    """Envelopes of three tables, by ``user_id`` modulo 3, in one frame."""
    env = fx.cdc_events(spark, sf_dir)

    def image(side, *cols):
        return F.when(F.col(side).isNotNull(), F.struct(*cols))

    def clicks(side):
        return image(side, F.col(side)["user_id"].alias("user_id"), F.col(side)["event_type"].alias("kind"))

    def amounts(side):
        i = F.col(side)
        amount = (i["event_id"].cast("decimal(18,0)") * F.lit(10**15).cast("decimal(18,0)") + i["user_id"]).cast("decimal(38,6)")
        return image(side, i["user_id"].cast("string").alias("uid"), amount.alias("amount"), F.timestamp_micros(i["ts"]).alias("at"), F.array(i["user_id"], i["event_id"]).alias("ids"))

    out = None
    for k, (table, shape) in enumerate(zip(MIRRORED, (None, clicks, amounts))):
        own = env.filter(F.coalesce("after.user_id", "before.user_id") % 3 == k)
        own = own if shape is None else own.withColumns({side: shape(side) for side in ("before", "after")})
        db, name = table.split(".")
        source = F.struct(F.lit(db).alias("db"), F.lit(name).alias("table"), F.col("source.ts_ms").alias("ts_ms"), "pos", F.col("order_ts"))
        texts = envelope.normalize_envelope(own.withColumn("source", source)).select("value")
        out = texts if out is None else out.union(texts)
    return out


def q3_mirror_tables(spark, sf_dir):
    """One stream of envelopes into three typed tables of different columns."""
    lines, path = fresh_path(spark, "lines"), fresh_path(spark, "mirror")
    _table_texts(spark, sf_dir).write.text(lines)
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(lines)
    images, keys = ({t: pair[i] for t, pair in MIRRORED.items()} for i in (0, 1))
    source = "db STRING, table STRING, ts_ms BIGINT, pos BIGINT, order_ts BIGINT"
    start_mirror_tables(stream, path, images, keys, ["source.order_ts", "source.pos"], source, buckets=8, merge_after=1).awaitTermination()
    events, clicks, amounts = (read_mirrored(spark, path, t) for t in MIRRORED)
    return (
        events.select(F.lit("events").alias("tbl"), "user_id", F.concat_ws("|", "event_id", "event_type", "ts", "props").alias("detail"))
        .union(clicks.select(F.lit("clicks"), "user_id", "kind"))
        .union(amounts.select(F.lit("amounts"), F.col("uid").cast("bigint"), F.concat_ws("|", F.col("amount").cast("string"), F.unix_micros("at"), F.array_join(F.col("ids").cast("array<string>"), ","))))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        s1_snapshot, s1_snapshot_envelopes, s2_initial, s2_initial_stream, s2_latest, s3_select_tables, s3_select_patterns,
        s7_offsets_for_times, s7_offsets_tail, s8_replay_from, s8_replay_earliest,
        t1_normalize, t1_normalize_mixed, t2_render_temporal, t2_order_dates, t3_unwrap_payload, t4_flatten, t4_flatten_decimals, t4_flatten_types,
        t5_effective_key, t6_row_kinds, t7_primary_key_map, t8_fan_out, t8_fan_out_stream,
        p1_hash_partition, p1_hash_temporal_key, p2_registry_partition, p3_partition_load, p4_allocate, p4_allocate_empty, p4_allocate_wide,
        p5_registry_for,
        k1_topic_frame, k1_ordered_frame, k1_registry_topic_frame, k2_encode_rows, k2_encode_orders, k3_delete_keys, k3_delete_event_keys, k3_remove_rows,
        k4_latest_rows, k4_apply_to_base, k4_moving_keys, k4_apply_stream, k4_apply_buckets, k5_debug_lines, k5_ordered_lines,
        q1_script_batch, q1_script_shared, q1_script_stream, q2_script_immediate, q3_mirror, q3_mirror_stream, q3_mirror_tables,
    )
} | {name: _pass_through(name) for name in PASS_THROUGH}
