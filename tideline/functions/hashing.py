"""The 32-bit polynomial string hash (factor 31 over UTF-16 code units)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK = 0xFFFFFFFF


def fold_hash(text: Column, start: Column) -> Column:
    """Continue an unsigned hash ``start`` over the characters of ``text``."""

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch).cast("bigint")
        low = (acc * 31 + code).bitwiseAND(F.lit(_MASK))
        over = code - 65536
        high_unit = F.shiftright(over, 10) + 55296
        low_unit = over.bitwiseAND(F.lit(1023)) + 56320
        pair = ((acc * 31 + high_unit) * 31 + low_unit).bitwiseAND(F.lit(_MASK))
        return F.when(code < 65536, low).otherwise(pair)

    folded = F.aggregate(F.split(text, ""), start.cast("bigint"), step)
    return F.when(text == "", start.cast("bigint")).otherwise(folded)


def signed32(value: Column) -> Column:
    return F.when(value > 0x7FFFFFFF, value - (1 << 32)).otherwise(value)


def string_hash(text: Column) -> Column:
    """Signed 32-bit hash of ``text`` as a bigint."""
    return signed32(fold_hash(text, F.lit(0)))
