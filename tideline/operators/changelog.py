"""Changelogs: keys, row kinds, deletes, and the table they add up to."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import model as m
from tideline.operators.images import field_by_name, image_type, same_struct
from tideline.operators.sizing import checked_broadcast


def primary_key_map(desc: DataFrame) -> DataFrame:
    """``(db_table, pk_column)`` from table descriptions (table, ordinal, Field, Key).

    A composite key is represented by its last column.
    """
    return (
        desc.filter(F.upper(F.trim("Key")) == "PRI")
        .groupBy(F.col("table").alias("db_table"))
        .agg(F.max_by("Field", "ordinal").alias("pk_column"))
    )


def key_map_frame(env: DataFrame, key_map: DataFrame | dict[str, str]) -> tuple[DataFrame, int | None]:
    """The key map as a frame, with its row count where that is known."""
    if isinstance(key_map, dict):
        rows = list(key_map.items())
        return env.sparkSession.createDataFrame(rows, "db_table STRING, pk_column STRING"), len(rows)
    return key_map.select("db_table", "pk_column"), None


def qualified_table() -> Column:
    return F.concat(F.trim("source.db"), F.lit("."), F.trim("source.table"))


def effective_key(env: DataFrame, key_map: DataFrame | dict[str, str]) -> DataFrame:
    """Add ``key_value``: the key from ``before`` for deletes, else from ``after``.

    It is ``""`` for an unknown table or a missing column.
    """
    keys, known = key_map_frame(env, key_map)
    keys = checked_broadcast(keys.withColumnRenamed("db_table", "_db_table"), known_rows=known)
    joined = env.withColumn("_db_table", qualified_table()).join(keys, "_db_table", "left")
    return _with_key_value(joined).drop("_db_table", "pk_column")


def _with_key_value(env: DataFrame) -> DataFrame:
    name = F.col("pk_column")
    before = field_by_name(F.col("before"), image_type(env, "before"), name)
    after = field_by_name(F.col("after"), image_type(env, "after"), name)
    key = F.when(F.col("op") == m.OP_DELETE, before).otherwise(after)
    return env.withColumn("key_value", F.coalesce(key, F.lit("")))


def to_row_kinds(env: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per row kind: ``row_kind``, ``extra`` columns, then the image fields."""
    fields = same_struct(env).names
    op, before, after = F.col("op"), F.col("before"), F.col("after")

    def kind(name: str, image: Column) -> Column:
        return F.struct(F.lit(name).alias("row_kind"), image.alias("image"))

    kinds = (
        F.when(op == m.OP_UPDATE, F.array(kind(m.UPDATE_BEFORE, before), kind(m.UPDATE_AFTER, after)))
        .when(op == m.OP_DELETE, F.array(kind(m.DELETE, before)))
        .otherwise(F.array(kind(m.INSERT, after)))
    )
    extra = extra or []
    return (
        env.select(*extra, F.inline(kinds))
        .filter(F.col("image").isNotNull())
        .select("row_kind", *extra, *[F.col("image")[f].alias(f) for f in fields])
    )


def delete_keys(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct key values that ``-D`` and ``-U`` rows remove (default: first field)."""
    key = key or next(c for c in rows.columns if c != "row_kind")
    removed = F.col("row_kind").isin(m.DELETE, m.UPDATE_BEFORE)
    return rows.filter(removed).select(key).distinct()


def remove_rows(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of a table of files whose key is not among ``keys``."""
    return table.join(keys, keys.columns, "left_anti")


def _keyed(env: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """``op`` and the key fields of both images as flat columns, plus ``more``.

    Single fields are picked first, so nothing else of an image has to be read.
    """
    picked = [F.col(side)[k].alias(f"_{side}_{k}") for side in ("before", "after") for k in keys]
    return env.select(F.col("op").alias("_op"), *picked, *more)


def _entries(keys: list[str], *written: Column, removed: list[Column] | None = None) -> Column:
    """One entry per change; an update that moves its key removes the old one too."""
    old = [F.col(f"_before_{k}") for k in keys]
    new = [F.col(f"_after_{k}") for k in keys]
    gone = F.col("_op") == m.OP_DELETE
    current = [F.when(gone, F.coalesce(o, n)).otherwise(n).alias(k) for k, o, n in zip(keys, old, new)]
    entry = F.struct(*current, *written)
    old_entry = F.struct(*[o.alias(k) for k, o in zip(keys, old)], *(removed or []))
    had_key = reduce(or_, [o.isNotNull() for o in old])
    changed = reduce(or_, [~o.eqNullSafe(n) for o, n in zip(old, new)])
    moved = (F.col("_op") == m.OP_UPDATE) & had_key & changed
    return F.inline(F.when(moved, F.array(old_entry, entry)).otherwise(F.array(entry)))


def changed_keys(env: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that the changes write or remove."""
    return _keyed(env, keys).select(_entries(keys)).distinct()


def keyed_images(env: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """``(keys…, _order, _image)`` per change; a null ``_image`` removes the key."""
    same_struct(env)
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    kept = F.when(F.col("op") != m.OP_DELETE, F.col("after"))
    rows = _keyed(env, keys, order.alias("_order"), kept.alias("_image"))
    nothing = F.when(F.lit(False), F.col("_image")).alias("_image")
    return rows.select(_entries(keys, F.col("_order"), F.col("_image"), removed=[F.col("_order"), nothing]))


def last_images(entries: DataFrame, keys: list[str]) -> DataFrame:
    """The entry with the greatest order per key.

    ``max_by`` is combined before the shuffle, so a hot key reaches its reducer
    as one row per map task.
    """
    return entries.groupBy(*keys).agg(
        F.max_by("_image", "_order").alias("_image"), F.max("_order").alias("_order")
    )


def apply_changelog(
    base: DataFrame | None, env: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """The table after all changes: latest image per key, removed keys gone.

    Changes are newer than ``base``. Base rows are only anti-joined with the
    changed keys, so a small change set leaves the base unshuffled.
    """
    entries = keyed_images(env, keys, order_by)
    upserts = last_images(entries, keys).filter(F.col("_image").isNotNull()).select("_image.*")
    if base is None:
        return upserts
    kept = remove_rows(base, changed_keys(env, keys))
    return kept.select(*upserts.columns).unionByName(upserts)


def fan_out(env: DataFrame, path: str, tables: list[str] | None = None, mode: str = "append") -> None:
    """Write each table's changes to its own ``db=…/table=…`` folder.

    Rows are added to what is there; ``mode="overwrite"`` replaces the tables that ``env`` has, and no others.
    The rebalance hint gathers a table's rows into few files and splits the
    partitions of a hot table.
    """
    rows = env.withColumns({"db": F.col("source.db"), "table": F.col("source.table")})
    if tables is not None:
        rows = rows.filter(F.concat_ws(".", "db", "table").isin(tables))
    (
        rows.hint("rebalance", F.col("db"), F.col("table"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("db", "table")
        .parquet(path)
    )
