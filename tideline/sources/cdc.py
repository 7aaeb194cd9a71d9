"""Snapshots and change streams as change frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import model as m


def cdc_snapshot(df: DataFrame, db: str, table: str, ts_ms: int, position: int | None = None) -> DataFrame:
    """Every row of a table as an ``r`` change."""
    image = F.struct(*df.columns)
    source = F.struct(
        F.lit(db).alias("db"),
        F.lit(table).alias("table"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        F.lit(position).cast("bigint").alias("pos"),
    )
    return df.select(
        F.when(F.lit(False), image).alias("before"),
        image.alias("after"),
        source.alias("source"),
        F.lit(m.OP_SNAPSHOT).alias("op"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    )


def cdc_source(
    snapshot: DataFrame | None,
    changes: DataFrame,
    startup: str = "latest",
    snapshot_pos: int | None = None,
) -> DataFrame:
    """``initial``: the snapshot, then the changes after it. Else: changes only.

    ``snapshot_pos`` is the last log position the snapshot contains; for
    ``latest`` it is the position to start behind.
    """
    after = changes if snapshot_pos is None else changes.filter(F.col("source.pos") > snapshot_pos)
    if startup != "initial":
        return after
    if snapshot is None or snapshot_pos is None:
        raise ValueError("startup 'initial' needs a snapshot and its position")
    return snapshot.unionByName(after)


def select_tables(
    env: DataFrame,
    databases: str | list[str] | None = None,
    tables: str | list[str] | None = None,
    patterns: bool = False,
) -> DataFrame:
    """Changes of the captured databases and ``db.table`` names (lists or comma text).

    With ``patterns`` the entries are regular expressions for the whole name.
    """
    for wanted, name in (
        (databases, F.col("source.db")),
        (tables, F.concat_ws(".", "source.db", "source.table")),
    ):
        if wanted is None:
            continue
        entries = [e.strip() for e in (wanted.split(",") if isinstance(wanted, str) else wanted)]
        if patterns:
            env = env.filter(name.rlike("^(?:" + "|".join(f"(?:{e})" for e in entries) + ")$"))
        else:
            env = env.filter(name.isin(entries))
    return env
