"""Access to before/after images, whatever their type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def image_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def field_by_name(image: Column, dtype: T.DataType, field: Column) -> Column:
    """Text of the field named by the column ``field``; null when missing."""
    if isinstance(dtype, T.StructType):
        picks = [F.when(field == f.name, image[f.name].cast("string")) for f in dtype.fields]
        return F.coalesce(*picks)
    if isinstance(dtype, T.MapType):
        return F.try_element_at(image, field).cast("string")
    return F.try_element_at(F.from_json(image, "map<string,string>"), field)


def same_struct(df: DataFrame) -> T.StructType:
    """The struct type shared by both images."""
    before, after = image_type(df, "before"), image_type(df, "after")
    if not isinstance(after, T.StructType) or before.simpleString() != after.simpleString():
        raise ValueError("before and after must be structs of one type; parse the envelope first")
    return after
