import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline import model as m
from tideline.functions.temporal import epoch_micros, render_temporal

EPOCH = dt.datetime(1970, 1, 1)


def ms(text):
    return (dt.datetime.fromisoformat(text) - EPOCH) // dt.timedelta(milliseconds=1)


def rendered(spark, value, kind, logical, **options):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(render_temporal(F.col("x"), logical, source_type=kind, **options)).first()[0]


@pytest.mark.parametrize(
    "value, logical, text",
    [
        (0, m.DATE, "1970-01-01"),
        (19_800, m.DATE, "2024-03-18"),
        (-1, m.DATE, "1969-12-31"),
        (0, m.TIME_MS, "00:00"),
        (45_240_000, m.TIME_MS, "12:34"),
        (45_296_000, m.TIME_MS, "12:34:56"),
        (45_240_100, m.TIME_MS, "12:34:00.100"),
        (45_296_007_999, m.TIME_US, "12:34:56.007"),
        (45_296_120_000_999, m.TIME_NS, "12:34:56.120"),
        (ms("2024-03-10 02:30:00"), m.TIMESTAMP_MS, "2024-03-10 02:30:00"),
        (ms("2024-03-10 02:30:00.120"), m.TIMESTAMP_MS, "2024-03-10 02:30:00.12"),
        (ms("2024-03-10 02:30:00.123"), m.TIMESTAMP_MS, "2024-03-10 02:30:00.123"),
        (ms("1960-05-06 07:08:09.5"), m.TIMESTAMP_MS, "1960-05-06 07:08:09.5"),
        (ms("2024-03-10 02:30:00.1") * 1000 + 999, m.TIMESTAMP_US, "2024-03-10 02:30:00.1"),
        (ms("2024-03-10 02:30:00") * 1000, m.TIMESTAMP_US, "2024-03-10 02:30:00.0"),
        (ms("2024-03-10 02:30:00.123") * 1_000_000 + 999_999, m.TIMESTAMP_NS, "2024-03-10 02:30:00.123"),
    ],
)
def test_numbers(spark, value, logical, text):
    assert rendered(spark, value, "bigint", logical) == text


@pytest.mark.parametrize("fraction, kept", [("", ""), (".100", ""), (".120", "."), (".123", ".1")])
def test_compat_cuts_two_characters(spark, fraction, kept):
    value = ms("2024-03-10 02:30:00" + fraction)
    assert rendered(spark, value, "bigint", m.TIMESTAMP_MS, compat=True) == "2024-03-10 02:30:00" + kept


def test_int_time(spark):
    assert rendered(spark, 45_296_000, "int", m.TIME_MS) == "12:34:56"
    assert rendered(spark, 45_296_000, "int", m.TIME_MS, compat=True) == "45296000"


@pytest.mark.parametrize(
    "value, text",
    [
        ("2024-01-01T20:00:00Z", "2024-01-02 04:00:00"),
        ("2024-01-01T20:00:00.500Z", "2024-01-02 04:00:00.5"),
        ("2024-01-01T20:00:00+08:00", "2024-01-01 20:00:00"),
    ],
)
def test_zoned(spark, value, text):
    assert rendered(spark, value, "string", m.ZONED) == text


def test_zoned_options(spark):
    assert rendered(spark, "2024-01-01T20:00:00Z", "string", m.ZONED, tz="UTC") == "2024-01-01 20:00:00"
    assert rendered(spark, "2024-01-01T20:00:00.123Z", "string", m.ZONED, compat=True) == "2024-01-02 04:00:00.1"


def test_zone_and_pass_through(spark):
    value = ms("2024-01-01 20:00:00")
    assert rendered(spark, value, "bigint", m.TIMESTAMP_MS, tz="Asia/Shanghai") == "2024-01-02 04:00:00"
    assert rendered(spark, 19_723, "bigint", m.DATE, tz="-05:00") == "2023-12-31"
    assert rendered(spark, 5, "bigint", None) == 5
    assert rendered(spark, "10:11:12.5", "string", m.TIME_US) == "10:11:12"
    assert rendered(spark, None, "bigint", m.TIMESTAMP_MS) is None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-30_000_000_000_000, 250_000_000_000_000), min_size=1, max_size=50))
def test_any_timestamp(spark, values):
    """Against Python's calendar, years 1019 to 9892."""
    df = spark.createDataFrame([(v,) for v in values], "x BIGINT")
    cols = [render_temporal(F.col("x"), m.TIMESTAMP_MS), render_temporal(F.col("x") * 1000, m.TIMESTAMP_US)]
    for v, row in zip(values, df.select(*cols).collect()):
        at = EPOCH + dt.timedelta(milliseconds=v)
        digits = f"{at.microsecond // 1000:03d}".rstrip("0")
        whole = f"{at:%Y-%m-%d %H:%M:%S}"
        assert row[0] == whole + ("." + digits if digits else "")
        assert row[1] == whole + "." + (digits or "0")


def test_native_types(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123456' AS n, TIMESTAMP'2024-01-01 20:00:00Z' AS z,"
        " DATE'2024-03-10' AS d, TIME'10:11:12.5' AS t"
    )
    kinds = dict(df.dtypes)

    def shown(name, logical):
        return df.select(render_temporal(F.col(name), logical, source_type=kinds[name])).first()[0]

    assert shown("n", m.TIMESTAMP_MS) == "2024-03-10 02:30:00.123"
    assert shown("n", m.TIMESTAMP_US) == "2024-03-10 02:30:00.123"
    assert shown("n", m.DATE) == shown("d", m.DATE) == "2024-03-10"
    assert shown("z", m.ZONED) == shown("z", m.TIMESTAMP_MS) == "2024-01-02 04:00:00"
    assert shown("t", m.TIME_US) == "10:11:12"


def test_session_zone_does_not_matter(spark):
    # 02:30 does not exist on this day in New York
    value = ms("2024-03-10 02:30:00.5")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rendered(spark, value, "bigint", m.TIMESTAMP_MS) == "2024-03-10 02:30:00.5"
        assert rendered(spark, "2024-03-10T02:30:00Z", "string", m.ZONED) == "2024-03-10 10:30:00"
        micros = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.500001' AS t").select(epoch_micros(F.col("t")))
        assert micros.first()[0] == value * 1000 + 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
