"""The copy job: a table and its changes, mirrored into a sink table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.changelog import apply_changelog, keyed_images
from tideline.operators.envelope import parse_envelopes
from tideline.sources.cdc import cdc_source, select_tables
from tideline.streaming import buckets as store
from tideline.streaming.apply import start_apply, write_base


def mirror_table(
    snapshot: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    startup: str = "initial",
    snapshot_pos: int | None = None,
    databases: str | None = None,
    tables: str | None = None,
) -> DataFrame:
    """Rows of the sink after copying snapshot and changes.

    Snapshot images are the base: they are older than every change.
    """
    captured = select_tables(cdc_source(None, changes, "latest", snapshot_pos), databases, tables)
    base = snapshot.select("after.*") if startup == "initial" and snapshot is not None else None
    return apply_changelog(base, captured, keys, order_by)


def start_mirror(
    changes: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    snapshot: DataFrame | None = None,
    snapshot_pos: int | None = None,
    databases: str | None = None,
    tables: str | None = None,
    **options,
) -> StreamingQuery:
    """The same copy as a continuous job over a stream of changes.

    With a snapshot the table starts from its images; ``snapshot_pos``, the last log position it
    contains, is where the changes begin. A restart finds the snapshot written and goes on.
    """
    captured = select_tables(cdc_source(None, changes, "latest", snapshot_pos), databases, tables)
    if snapshot is not None:
        if snapshot_pos is None:
            raise ValueError("a snapshot needs its position")
        write_base(select_tables(snapshot, databases, tables), captured, path, keys, order_by)
    return start_apply(captured, path, keys, order_by, **options)


#: What identifies a row of a store of many tables: the table's number, and its key as text.
TABLE_KEYS = ["_table", "_key"]


def write_tables_batch(
    env: DataFrame,
    batch_id: int,
    path: str,
    keys: dict[str, list[str]],
    order_by: list[str],
    buckets: int = store.BUCKETS,
    merge_after: int = store.MERGE_AFTER,
) -> None:
    """Apply one batch of changes of many tables (as from ``parse_envelopes``) in one write.

    ``keys`` maps ``db.table`` to its key columns, in the order of the images. Each table has ``buckets`` buckets of its
    own. All tables are published together, so readers see them at one position. Tables may be added at the end of
    ``keys``, and columns to a table.
    """
    spark, names = env.sparkSession, list(keys)
    old = store.read_manifest(spark, path)
    if old is not None and names[: len(old.tables)] != old.tables:
        raise ValueError(f"{path} holds the tables {old.tables}; new ones come after them")
    n = old.buckets if old else buckets

    def keyed(side: str) -> Column:
        texts = [F.when(F.col(side)[f"t{k}"].isNotNull(), F.to_json(F.struct(*[F.col(side)[f"t{k}"][c] for c in keys[name]]))) for k, name in enumerate(names)]
        image = F.struct(F.col("table_no").alias("_table"), F.coalesce(*texts).alias("_key"), F.col(side).alias("row"))
        return F.when(F.col(side).isNotNull(), image).alias(side)

    rows = env.select("op", keyed("before"), keyed("after"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)])
    entries = keyed_images(rows, TABLE_KEYS, [f"_o{i}" for i in range(len(order_by))]).withColumn("_image", F.col("_image.row"))
    entries = entries.withColumn("bucket", F.col("_table") * n + store.bucket_of(["_key"], n))
    store.write_entries(spark, entries, batch_id, path, TABLE_KEYS, n, merge_after, names)


def start_mirror_tables(
    texts: DataFrame,
    path: str,
    images: dict[str, T.StructType | str],
    keys: dict[str, list[str]],
    order_by: list[str],
    source: T.StructType | str = "db STRING, table STRING, ts_ms BIGINT, pos BIGINT",
    temporal: dict[str, dict[str, str]] | None = None,
    unknown: str = "error",
    buckets: int = store.BUCKETS,
    merge_after: int = store.MERGE_AFTER,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Copy a stream of envelopes (column ``value``) of many tables into typed tables, as one job.

    ``images`` maps ``db.table`` to its columns and ``keys`` to its key columns; ``order_by`` names fields of the change
    frame, such as ``source.pos``. Each envelope is parsed once, and each batch is written once.
    """
    if list(images) != list(keys):
        raise ValueError("images and keys must name the same tables in the same order")
    env = parse_envelopes(texts, images, source, temporal=temporal, unknown=unknown)
    return store.start_batches(env, path, lambda batch, i: write_tables_batch(batch, i, path, keys, order_by, buckets, merge_after), checkpoint, trigger)


def read_mirrored(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The current rows of one table of ``start_mirror_tables``; only its own buckets and columns are read."""
    manifest = store.read_manifest(spark, path)
    if manifest is None or table not in manifest.tables:
        raise ValueError(f"{path} holds no table {table}")
    k = manifest.tables.index(table)
    stored = T.StructType.fromJson(json.loads(manifest.schema))
    own = T.StructType([f if f.name != "_image" else T.StructField("_image", T.StructType([f.dataType[f"t{k}"]])) for f in stored.fields])
    mine = list(range(k * manifest.buckets, (k + 1) * manifest.buckets))
    rows = store.read_entries(spark, path, mine, own)
    return rows.filter(F.col("_image").isNotNull()).select(f"_image.t{k}.*")
