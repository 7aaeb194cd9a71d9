"""Temporal values as text, by logical type.

All arithmetic is on zone-less timestamps, so results do not depend on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline import model as m

_PER_MS = {m.TIME_US: 1_000, m.TIME_NS: 1_000_000, m.TIMESTAMP_US: 1_000, m.TIMESTAMP_NS: 1_000_000}
_TIMES = (m.TIME_MS, m.TIME_US, m.TIME_NS)
_TIMESTAMPS = (m.TIMESTAMP_MS, m.TIMESTAMP_US, m.TIMESTAMP_NS)

# how Spark's own timestamps are shown: zone-less ones as they are, instants zoned
NATIVE = {"timestamp_ntz": m.TIMESTAMP_MS, "timestamp": m.ZONED}


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _shift(local: Column, tz: str) -> Column:
    return local if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), local)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, read as UTC."""
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def _time_text(local: Column) -> Column:
    # HH:mm, HH:mm:ss or HH:mm:ss.SSS: seconds only when not zero
    text = F.substring(local.cast("string"), 12, 15)
    return (
        F.when(F.length(text) > 8, F.rpad(text, 12, "0"))
        .when(F.endswith(text, F.lit(":00")), F.substring(text, 1, 5))
        .otherwise(text)
    )


def _with_fraction(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def _drop_last_two(text: Column) -> Column:
    full = _with_fraction(text)
    return F.substring(full, F.lit(1), F.length(full) - 2)


def render_temporal(
    col: Column,
    logical_type: str | None,
    tz: str | None = None,
    compat: bool = False,
    source_type: str = "bigint",
) -> Column:
    """Text of a temporal value; other logical types pass through unchanged.

    ``source_type`` is the column's type: a number by default, else ``string``
    or one of Spark's own temporal types; instants (``timestamp``) are shown as
    zoned. ``tz`` defaults to UTC, for zoned timestamps to +08:00. ``compat``
    keeps two old habits: millisecond and zoned timestamps lose their last two
    characters even when they hold a real fraction, and 32-bit times stay numbers.
    """
    if logical_type == m.ZONED or (logical_type in _TIMESTAMPS and source_type in ("string", "timestamp")):
        instant = F.timestamp_add("MICROSECOND", F.unix_micros(col.cast("timestamp")), _epoch())
        text = _shift(instant, tz or m.ZONED_OFFSET).cast("string")
        return _drop_last_two(text) if compat else text
    zone = tz or "UTC"
    if logical_type == m.DATE:
        if source_type in ("date", "timestamp_ntz"):
            return F.to_date(col).cast("string")
        if zone == "UTC":
            return F.date_add(F.lit("1970-01-01").cast("date"), col.cast("int")).cast("string")
        local = _shift(F.timestamp_add("DAY", col.cast("bigint"), _epoch()), zone)
        return F.to_date(local).cast("string")
    if logical_type in _TIMES and (source_type == "string" or source_type.startswith("time(")):
        return F.substring(col.cast("string"), 1, 8)
    if logical_type == m.TIME_MS and source_type == "int" and compat:
        return col.cast("string")
    if logical_type in _TIMES or logical_type in _TIMESTAMPS:
        if source_type == "timestamp_ntz":
            millis = F.call_function("div", epoch_micros(col), F.lit(1000))
        else:
            millis = col.cast("bigint")
        if logical_type in _PER_MS and source_type != "timestamp_ntz":
            millis = F.call_function("div", millis, F.lit(_PER_MS[logical_type]))
        local = _shift(F.timestamp_add("MILLISECOND", millis, _epoch()), zone)
        if logical_type in _TIMES:
            return _time_text(local)
        text = local.cast("string")
        if logical_type == m.TIMESTAMP_MS:
            return _drop_last_two(text) if compat else text
        return _with_fraction(text)
    return col


def sql_text(col: Column, source_type: str) -> Column:
    """Spark's own timestamps as SQL text: ``yyyy-MM-dd HH:mm:ss[.f]``, instants in UTC with ``Z``."""
    if source_type == "timestamp_ntz":
        return col.cast("string")
    if source_type == "timestamp":
        utc = F.timestamp_add("MICROSECOND", F.unix_micros(col), _epoch())
        return F.concat(utc.cast("string"), F.lit("Z"))
    return col
