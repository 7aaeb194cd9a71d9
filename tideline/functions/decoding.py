"""Values from the text that an envelope shows: the inverse of its rendering, by type and logical type.

Results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import model as m
from tideline.functions.temporal import epoch_micros

#: Units of a microsecond, or microseconds of a unit, by logical type.
_FINER = {m.TIME_NS: 1_000, m.TIMESTAMP_NS: 1_000}
_COARSER = {m.TIME_MS: 1_000, m.TIMESTAMP_MS: 1_000}
_TIMES = (m.TIME_MS, m.TIME_US, m.TIME_NS)
_TIMESTAMPS = (m.TIMESTAMP_MS, m.TIMESTAMP_US, m.TIMESTAMP_NS)
_NESTED = (T.ArrayType, T.MapType, T.StructType)
_PLAIN = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)
#: A time with an offset of its own: ``Z``, ``+08:00``, ``+0800`` or ``+08``.
_OFFSET = r":\d\d(\.\d+)?\s*(Z|[+-]\d\d(:?\d\d)?)$"


def decodable(dtype: T.DataType) -> bool:
    """Whether ``from_text`` knows the type."""
    return isinstance(dtype, (*_PLAIN, *_NESTED, T.TimestampType, T.BinaryType))


def _cast(text: Column, dtype: T.DataType | str, strict: bool) -> Column:
    return text.cast(dtype) if strict else text.try_cast(dtype)


def _day_micros(text: Column, strict: bool) -> Column:
    """Microseconds of the day of ``HH:mm``, ``HH:mm:ss`` or ``HH:mm:ss.f``."""
    return epoch_micros(_cast(F.concat(F.lit("1970-01-01 "), text), "timestamp_ntz", strict))


def _instant(text: Column, zone: str, strict: bool) -> Column:
    local = _cast(text, "timestamp_ntz", strict)
    here = F.timestamp_micros(epoch_micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), local)))
    return F.when(text.rlike(_OFFSET), _cast(text, "timestamp", strict)).otherwise(here)


def from_text(text: Column, dtype: T.DataType, logical: str | None = None, strict: bool = True) -> Column:
    """The value of type ``dtype`` that is shown as ``text``; null for a null text.

    Instants are read at the offset they are written with: their own, UTC for the timestamp types, else
    ``+08:00``. Numbers of a logical type come back in its unit, as far as the text shows it. Binary values are
    base64; arrays, maps and structs are JSON. A text that is no such value fails, or is null if not ``strict``.
    """
    if isinstance(dtype, T.NumericType) and logical == m.DATE:
        return F.unix_date(_cast(text, "date", strict)).cast(dtype)
    if isinstance(dtype, T.NumericType) and logical in (*_TIMES, *_TIMESTAMPS):
        micros = _day_micros(text, strict) if logical in _TIMES else epoch_micros(_cast(text, "timestamp_ntz", strict))
        micros = F.call_function("div", micros, F.lit(_COARSER.get(logical, 1))) * _FINER.get(logical, 1)
        return micros.cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return _instant(text, "UTC" if logical in _TIMESTAMPS else m.ZONED_OFFSET, strict)
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(text) if strict else F.try_to_binary(text, F.lit("base64"))
    if isinstance(dtype, _NESTED):
        return F.from_json(text, dtype, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    return text if isinstance(dtype, T.StringType) else _cast(text, dtype, strict)
