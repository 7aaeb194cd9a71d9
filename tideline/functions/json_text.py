"""Struct fields for JSON text in which null is written as ``""``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(name: str, value: Column, present: Column | None = None) -> list[Column]:
    """Two struct fields of one name, of which exactly one is not null.

    ``to_json`` leaves null fields out, so a field of any type is written either
    as itself or as ``""``, in one pass over the struct. Where ``present`` is
    false neither is written.
    """
    missing = value.isNull() if present is None else present & value.isNull()
    return [value.alias(name), F.when(missing, "").alias(name)]


def object_text(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})
