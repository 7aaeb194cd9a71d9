import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import model as m
from tideline.operators.envelope import (
    flatten_changes,
    normalize_envelope,
    parse_envelope,
    parse_envelopes,
    unwrap_payload,
)

IMAGE = "id BIGINT, name STRING, price DECIMAL(10,2), ok BOOLEAN, at BIGINT"
FRAME = (
    f"before STRUCT<{IMAGE}>, after STRUCT<{IMAGE}>, "
    "source STRUCT<db: STRING, table: STRING, ts_ms: BIGINT>, op STRING, ts_ms BIGINT, transaction STRING"
)
SOURCE = ("shop", "t1", 5)
ROW = (1, 'a"b\\c\n/é😀', None, True, 1_704_067_200_000)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), FRAME)


def values(df):
    return [json.loads(r.value) for r in df.select("value").collect()]


def test_members(spark):
    [got] = values(normalize_envelope(frame(spark, (None, ROW, SOURCE, "c", 7, None))))
    assert got == {
        "before": {},
        "after": {"id": 1, "name": 'a"b\\c\n/é😀', "price": "", "ok": True, "at": 1_704_067_200_000},
        "source": {"db": "shop", "table": "t1", "ts_ms": 5},
        "op": "c",
        "ts_ms": 7,
        "transaction": "",
    }


def test_order_of_members_and_left_out_nulls(spark):
    [row] = normalize_envelope(frame(spark, (ROW, None, SOURCE, None, None, "tx1"))).collect()
    got = json.loads(row.value)
    assert list(got) == ["before", "after", "source", "transaction"]
    assert got["after"] == {} and got["transaction"] == "tx1"


def test_rows_without_source_are_dropped(spark):
    assert normalize_envelope(frame(spark, (None, ROW, None, "c", 7, None))).count() == 0


def test_all_null_image_is_not_absent(spark):
    [got] = values(normalize_envelope(frame(spark, (None, (None,) * 5, SOURCE, "c", 7, None))))
    assert got["after"] == {"id": "", "name": "", "price": "", "ok": "", "at": ""}


def test_temporal_fields(spark):
    env = frame(spark, (ROW, ROW, SOURCE, "u", 7, None), (None, ROW[:4] + (None,), SOURCE, "c", 7, None))
    first, second = values(normalize_envelope(env, {"at": m.TIMESTAMP_MS}))
    assert first["after"]["at"] == first["before"]["at"] == "2024-01-01 00:00:00"
    assert second["after"]["at"] == ""


def test_int_time_compat_stays_a_number(spark):
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None)).withColumn(
        "after", F.struct(F.lit(45_296_000).alias("t"))
    )
    [got] = values(normalize_envelope(env, {"t": m.TIME_MS}, compat=True))
    assert got["after"] == {"t": 45_296_000}
    [got] = values(normalize_envelope(env, {"t": m.TIME_MS}))
    assert got["after"] == {"t": "12:34:56"}


def test_timestamps_of_spark_types(spark):
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None)).withColumn(
        "after",
        F.expr(
            "named_struct('n', TIMESTAMP_NTZ'2024-01-01 00:00:00', 'z', TIMESTAMP'2024-01-01 00:00:00Z', "
            "'d', DATE'2024-01-02')"
        ),
    )
    [got] = values(normalize_envelope(env))
    assert got["after"] == {"n": "2024-01-01 00:00:00", "z": "2024-01-01 08:00:00", "d": "2024-01-02"}


def test_map_and_text_images(spark):
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None))
    maps = env.withColumn("after", F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string")))
    [got] = values(normalize_envelope(maps))
    assert got["after"] == {"a": "1", "b": ""}
    absent = maps.withColumn("after", F.lit(None).cast("map<string,string>"))
    assert values(normalize_envelope(absent))[0]["after"] == {}
    texts = env.withColumns({"before": F.lit(None).cast("string"), "after": F.lit('{"x":[1,{"y":2}]}')})
    [got] = values(normalize_envelope(texts))
    assert got["before"] == {} and got["after"] == {"x": [1, {"y": 2}]}


def test_exact_numbers(spark):
    text = '{"payload":{"after":{"a":12345678901234567890.123456789012,"b":1.10,"c":"","d":null},"op":"c"}}'
    df = spark.createDataFrame([(text,)], "value STRING")
    assert "12345678901234567890.123456789012" in unwrap_payload(df).first().value
    declared = "a DECIMAL(38,12), b DECIMAL(10,2), c STRING, d STRING"
    row = parse_envelope(df, declared).first().after
    assert (str(row.a), str(row.b), row.c, row.d) == ("12345678901234567890.123456789012", "1.10", "", None)
    assert parse_envelope(df, declared, empty_as_null=True).first().after.c is None


def test_untyped_images_follow_the_rules(spark):
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None))
    text = env.withColumns({"before": F.lit(None).cast("string"), "after": F.lit('{"x":null,"at":1704067200000,"n":12345678901234567890.5}')})
    [got] = values(normalize_envelope(text, {"at": m.TIMESTAMP_MS}))
    assert got["after"] == {"x": "", "at": "2024-01-01 00:00:00", "n": 12345678901234567890.5}
    own = {"shop.t1": {"at": m.DATE}, "at": m.TIMESTAMP_MS}
    days = text.withColumn("after", F.lit('{"at":19723}'))
    assert values(normalize_envelope(days, own))[0]["after"] == {"at": "2024-01-01"}
    maps = text.withColumns({c: F.create_map(F.lit("at"), F.lit("1704067200000"), F.lit("y"), F.lit(None).cast("string")) for c in ("before", "after")})
    assert values(normalize_envelope(maps, {"at": m.TIMESTAMP_MS}))[0]["after"] == {"at": "2024-01-01 00:00:00", "y": ""}


def test_a_null_payload_is_no_change(spark):
    text = '{"payload":null,"op":"c","after":{"id":1},"source":{"db":"d"}}'
    df = spark.createDataFrame([(text,)], "value STRING")
    with pytest.raises((PySparkException, Py4JJavaError), match="payload of an envelope is null"):
        parse_envelope(df, IMAGE).collect()
    row = parse_envelope(df, IMAGE, mode="PERMISSIVE").first()
    assert (row.op, row.after.id) == ("c", 1)
    assert unwrap_payload(df).first().value == text
    # the word alone is no null payload
    other = spark.createDataFrame([('{"op":"c","after":{"name":"\\"payload\\":null"}}',)], "value STRING")
    assert parse_envelope(other, IMAGE).first().after.name == '"payload":null'


def test_decimals_of_too_many_digits_fail(spark):
    text = '{"after":{"id":1,"price":123456789012345678901234567890.123456789012}}'
    df = spark.createDataFrame([(text,)], "value STRING")
    with pytest.raises((PySparkException, Py4JJavaError), match="more than 38 digits"):
        parse_envelope(df, "id BIGINT, price DECIMAL(38,2)").collect()
    assert parse_envelope(df, "id BIGINT, price DECIMAL(38,2)", mode="PERMISSIVE").first().after.price is None
    short = spark.createDataFrame([('{"after":{"id":1,"price":1.5E3}}',)], "value STRING")
    assert str(parse_envelope(short, "id BIGINT, price DECIMAL(38,2)").first().after.price) == "1500.00"


TYPED = """id BIGINT, raw BINARY, moment TIMESTAMP, local TIMESTAMP_NTZ, day DATE, tags ARRAY<STRING>, sizes ARRAY<DECIMAL(30,4)>,
  attrs MAP<STRING,INT>, inner STRUCT<a: INT, b: STRING>, big DECIMAL(38,0), ok BOOLEAN, x DOUBLE"""
TYPED_ROW = """SELECT 1L, unhex('00ff10'), TIMESTAMP'2024-01-02 03:04:05.123456 UTC', TIMESTAMP_NTZ'2024-01-02 03:04:05', DATE'2024-02-29',
  array('a', null, '"q"'), array(12345678901234567890123456.7891BD, null), map('k', 1), named_struct('a', 7, 'b', 'é'), 98765432109876543210987654321098765432BD, true, 0.1D"""


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_columns_of_every_type_come_back(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql(f"{TYPED_ROW} UNION ALL SELECT 2L, null, null, null, null, null, null, null, null, null, null, null")
        rows = rows.toDF(*[f"c{k}" for k in range(12)])
        rows = rows.select(F.struct(*rows.columns).cast(T.StructType.fromDDL(TYPED)).alias("after"))
        env = rows.select(
            F.when(F.lit(False), F.col("after")).alias("before"), "after",
            F.expr("named_struct('db', 'shop', 'table', 't', 'ts_ms', 1L)").alias("source"),
            F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("ts_ms"), F.lit(None).cast("string").alias("transaction"),
        )
        back = parse_envelope(normalize_envelope(env).select("value"), TYPED)
        assert back.selectExpr("after.*").orderBy("id").collect() == env.selectExpr("after.*").orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers_of_logical_types_come_back(spark):
    rules = {"d": m.DATE, "t": m.TIME_US, "tn": m.TIME_NS, "ms": m.TIMESTAMP_MS, "us": m.TIMESTAMP_US, "ns": m.TIMESTAMP_NS}
    schema = "d INT, t BIGINT, tn BIGINT, ms BIGINT, us BIGINT, ns BIGINT"
    rows = [(19723, 3_723_004_000, 3_600_000_000_000, 1704067200123, 1704067200123000, -1_000_000), (-1, 0, 60_000_000_000, -1, 0, 5_000_000)]
    images = spark.createDataFrame([(r,) for r in rows], T.StructType().add("after", T.StructType.fromDDL(schema)))
    env = images.selectExpr(
        "CASE WHEN false THEN after END before", "after", "named_struct('db','shop','table','t','ts_ms',1L) source", "'c' op", "1L ts_ms", "CAST(null AS STRING) transaction")
    back = parse_envelope(normalize_envelope(env, rules).select("value"), schema, temporal=rules).selectExpr("after.*").collect()
    assert sorted(map(tuple, back)) == sorted(rows)


def test_instants_keep_an_offset_of_their_own(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05.5+02:00", "2024-01-02 03:04:05"]
    df = spark.createDataFrame([(json.dumps({"after": {"at": t}}),) for t in texts], "value STRING")
    got = parse_envelope(df, "at TIMESTAMP").selectExpr("CAST(unix_micros(after.at) AS STRING)").collect()
    assert [r[0] for r in got] == ["1704164645000000", "1704157445500000", "1704135845000000"]


def test_types_that_no_envelope_shows_are_refused_by_name(spark):
    df = spark.createDataFrame([("{}",)], "value STRING")
    with pytest.raises(ValueError, match="column v .* interval"):
        parse_envelope(df, "id INT, v INTERVAL DAY")


TABLES = {"shop.a": "id BIGINT, name STRING, at TIMESTAMP", "shop.b": "Id STRING, price DECIMAL(38,18), raw BINARY", "crm.c": "id INT, name ARRAY<INT>"}


def many(spark, *more):
    envelopes = [
        {"after": {"id": 1, "name": "x", "at": "2024-01-02 11:04:05"}, "source": {"db": "shop", "table": "a"}, "op": "c", "ts_ms": 1},
        {"payload": {"before": {"Id": "k", "price": "", "raw": "AP8Q"}, "source": {"db": "shop ", "table": "b"}, "op": "d", "ts_ms": 2}},
        {"before": {"id": 3, "name": [1, 2]}, "after": {"id": 3, "name": []}, "source": {"db": "crm", "table": "c"}, "op": "u", "ts_ms": 3}, *more]
    return spark.createDataFrame([(json.dumps(e), k) for k, e in enumerate(envelopes)], "value STRING, k INT")


def test_envelopes_of_many_tables(spark):
    rows = parse_envelopes(many(spark), TABLES).orderBy("k").collect()
    assert [(r.table_no, r.op, r.source.table) for r in rows] == [(0, "c", "a"), (1, "d", "b"), (2, "u", "c")]
    assert rows[0].before is None and rows[0].after.t0.name == "x" and rows[0].after.t1 is None and rows[0].after.t2 is None
    assert rows[1].after is None and (rows[1].before.t1.Id, rows[1].before.t1.price, bytes(rows[1].before.t1.raw)) == ("k", None, b"\x00\xff\x10")
    assert (rows[2].before.t2.name, rows[2].after.t2.name) == ([1, 2], [])
    texts = many(spark, {"after": {"id": 9}, "source": {"db": "shop", "table": "z"}, "op": "c"})
    with pytest.raises((PySparkException, Py4JJavaError), match="no columns are known of shop.z"):
        parse_envelopes(texts, TABLES).collect()
    assert parse_envelopes(texts, TABLES, unknown="drop").count() == 3


def test_unwrap(spark):
    bare = '{"op":"c","after":{"x":1}}'
    df = spark.createDataFrame([(bare,), ('{"schema":{},"payload":' + bare + "}",)], "value STRING")
    assert [json.loads(r.value) for r in unwrap_payload(df).collect()] == [json.loads(bare)] * 2


def test_transaction_block(spark):
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None)).withColumn(
        "transaction", F.struct(F.lit("tx1").alias("id"), F.lit(3).alias("total_order"))
    )
    assert values(normalize_envelope(env))[0]["transaction"] == {"id": "tx1", "total_order": 3}
    none = env.withColumn("transaction", F.when(F.lit(False), F.col("transaction")))
    assert values(normalize_envelope(none))[0]["transaction"] == ""


def test_round_trip(spark):
    env = frame(
        spark,
        (None, ROW, SOURCE, "c", 7, None),
        (ROW, (2, "", None, None, None), SOURCE, "u", 8, "tx"),
        (ROW, None, SOURCE, "d", 9, None),
    )
    text = normalize_envelope(env).select("value")
    wrapped = text.select(F.concat(F.lit('{"payload":'), "value", F.lit("}")).alias("value"))
    for df in (text, wrapped):
        back = parse_envelope(df, IMAGE).orderBy("ts_ms").collect()
        assert back == env.orderBy("ts_ms").collect()


@pytest.mark.parametrize(
    "text, error",
    [
        ("{oops", "MALFORMED_RECORD"),
        ('{"op":"c","source":{"db":"d"},"after":{"id":"1","at":"no number"}}', "CAST_INVALID_INPUT"),
    ],
)
def test_bad_text_fails_unless_permitted(spark, text, error):
    df = spark.createDataFrame([(text,)], "value STRING")
    with pytest.raises((PySparkException, Py4JJavaError), match=error):
        parse_envelope(df, IMAGE).collect()
    row = parse_envelope(df, IMAGE, mode="PERMISSIVE").first()
    assert row.after is None if text == "{oops" else (row.after.id, row.after["at"]) == (1, None)


def test_flatten(spark):
    declared = "id BIGINT, name STRING, price DECIMAL(10,2), ok BOOLEAN, at TIMESTAMP_NTZ"
    env = frame(spark, (None, ROW, SOURCE, "c", 7, None), (ROW, None, SOURCE, "d", 8, None))
    text = normalize_envelope(env, {"at": m.TIMESTAMP_MS}).select("value")
    rows = flatten_changes(text, declared).orderBy("ts_ms").collect()
    assert [r.op for r in rows] == ["c", "d"]
    assert rows[0].db == "shop" and rows[0].table == "t1"
    assert rows[0].price is None and str(rows[1]["at"]) == "2024-01-01 00:00:00"
    typed = flatten_changes(env, IMAGE).orderBy("ts_ms").collect()
    assert typed[1].id == 1 and typed[1].ok is True
