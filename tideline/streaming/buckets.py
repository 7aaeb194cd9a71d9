"""Continuous changelog apply on a table of key buckets, published by one manifest file.

Layout under the table path: ``data/v=V/bucket=B`` holds rows that version V wrote for bucket B: per key its
last image (null for a removed key, kept so that a late change can't bring it back) and the order of that image.
``manifest.json`` names the parts of every bucket. A batch writes only buckets that its keys fall into: a part with its
own last images, and, where a bucket has too many parts, one merged part in their place. All other files stay as
they are. Then the manifest is replaced in one step, so readers see whole batches, and
a read takes one small file and the parts it names, however many batches there were.

A version that was cut off before it was published is written again. A batch that is published
already is passed over.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.changelog import keyed_images, last_images
from tideline.streaming.apply import _file_system, own_checkpoint
from tideline.streaming.files import read_text, replace_text

#: Buckets of a table, and parts of a bucket above which it is merged.
BUCKETS, MERGE_AFTER = 64, 4


@dataclass(frozen=True)
class Manifest:
    """What a table consists of. ``parts`` maps a bucket to the folders below ``data`` that hold it, oldest first."""

    version: int
    batch: int
    buckets: int
    keys: list[str]
    schema: str
    parts: dict[int, list[str]] = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps(self.__dict__)


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The published state of a table; None before its first batch."""
    text = read_text(spark, f"{path}/manifest.json")
    if text is None:
        return None
    found = json.loads(text)
    return Manifest(**found | {"parts": {int(b): p for b, p in found["parts"].items()}})


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Replace the manifest in one step; fails if another version was published meanwhile."""
    now = read_manifest(spark, path)
    if (now.version if now else -1) != manifest.version - 1:
        raise RuntimeError(f"{path} was changed by another job")
    replace_text(spark, f"{path}/manifest.json", f"{path}/manifest-{manifest.version}.json.draft", manifest.text())


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, folder: str) -> list[int]:
    """Write rows by bucket, and tell which buckets there are. Large buckets are split, small files gathered."""
    rows.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(folder)
    files, target = _file_system(rows.sparkSession, folder)
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted(int(name.split("=")[1]) for name in names if name.startswith("bucket="))


def _rows(spark: SparkSession, path: str, manifest: Manifest, buckets: list[int], schema: T.StructType | None = None) -> DataFrame | None:
    """The stored rows of some buckets, with their bucket."""
    folders = [f"{path}/data/{part}/bucket={b}" for b in buckets for part in manifest.parts.get(b, [])]
    if not folders:
        return None
    schema = schema or T.StructType.fromJson(json.loads(manifest.schema))
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
    return read.option("basePath", f"{path}/data").parquet(*folders).select(*schema.names, "bucket")


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    return last_images(rows, ["bucket", *keys])


def _next(spark: SparkSession, path: str, old: Manifest, entries: DataFrame | None, merge_after: int, **changed) -> Manifest:
    """Write what the next version adds to ``old``, and say what it consists of."""
    version = old.version + 1
    parts = {b: list(p) for b, p in old.parts.items()}
    new = replace(old, version=version, parts=parts, **changed)
    if entries is not None:
        for b in _write(entries, f"{path}/data/v={version}"):
            parts.setdefault(b, []).append(f"v={version}")
    crowded = [b for b, p in parts.items() if len(p) > max(1, merge_after)]
    if crowded:
        for b in _write(_merged(_rows(spark, path, new, crowded), new.keys), f"{path}/data/v={version}-merged"):
            parts[b] = [f"v={version}-merged"]
    return new


def _stored(entries: DataFrame) -> str:
    return entries.drop("bucket").schema.json()


def write_entries(
    spark: SparkSession, entries: DataFrame, batch_id: int, path: str, keys: list[str], buckets: int, merge_after: int = MERGE_AFTER, tables: list[str] | None = None
) -> None:
    """Add one batch of (keys…, _image, _order, bucket) rows, several per key possibly, and publish it."""
    old = read_manifest(spark, path)
    if old is not None and batch_id <= old.batch:
        return
    folded = _merged(entries, keys)
    old = old or Manifest(-1, -1, buckets, keys, _stored(folded))
    publish(spark, path, _next(spark, path, old, folded, merge_after, batch=batch_id, schema=_stored(folded), tables=tables or old.tables))


def write_batch(env: DataFrame, batch_id: int, path: str, keys: list[str], order_by: list[str], buckets: int = BUCKETS, merge_after: int = MERGE_AFTER) -> None:
    """Apply one micro-batch of changes. The number of buckets is that of the table, once there is one."""
    spark = env.sparkSession
    old = read_manifest(spark, path)
    n = old.buckets if old else buckets
    entries = keyed_images(env, keys, order_by).withColumn("bucket", bucket_of(keys, n))
    write_entries(spark, entries, batch_id, path, keys, n, merge_after)


def write_base(snapshot: DataFrame, changes: DataFrame, path: str, keys: list[str], order_by: list[str], buckets: int = BUCKETS) -> None:
    """Store the images of a snapshot as the first version, older than any change; nothing if there is a version."""
    spark = snapshot.sparkSession
    if read_manifest(spark, path) is not None:
        return
    order = changes.select(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]).alias("_order")).schema["_order"].dataType
    least = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in order.fields])  # no null: max_by passes over these
    rows = snapshot.select(*[F.col("after")[k].alias(k) for k in keys], F.col("after").alias("_image"), least.alias("_order"))
    rows = rows.withColumn("bucket", bucket_of(keys, buckets))
    publish(spark, path, _next(spark, path, Manifest(-1, -1, buckets, keys, _stored(rows)), rows, MERGE_AFTER))


def start_apply(
    stream: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    buckets: int = BUCKETS,
    merge_after: int = MERGE_AFTER,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply a stream of changes to the table at ``path``; the checkpoint belongs to the path, as batches are numbered by it."""
    return start_batches(stream, path, lambda env, i: write_batch(env, i, path, keys, order_by, buckets, merge_after), checkpoint, trigger)


def start_batches(stream: DataFrame, path: str, write, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Run ``write(batch, id)`` for each micro-batch of the table at ``path``."""
    checkpoint = checkpoint or f"{path}/_checkpoint"
    old = read_manifest(stream.sparkSession, path)
    if old is not None and old.batch >= 0:
        own_checkpoint(stream.sparkSession, f"{path}/data", checkpoint)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_entries(spark: SparkSession, path: str, buckets: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The last image of every key, removed ones included. Buckets of one part are read as they are, without a shuffle."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} holds no finished batch")
    chosen = [b for b in manifest.parts if buckets is None or b in buckets]
    whole = _rows(spark, path, manifest, [b for b in chosen if len(manifest.parts[b]) == 1], schema)
    several = _rows(spark, path, manifest, [b for b in chosen if len(manifest.parts[b]) > 1], schema)
    out = [whole] if whole is not None else []
    if several is not None:
        out.append(_merged(several, manifest.keys).select(*several.columns))
    if not out:
        schema = schema or T.StructType.fromJson(json.loads(manifest.schema))
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of the table."""
    return read_entries(spark, path).filter(F.col("_image").isNotNull()).select("_image.*")


def read_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The current rows of some keys; only their buckets are read."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} holds no finished batch")
    types = {f["name"]: f["type"] for f in json.loads(manifest.schema)["fields"]}
    typed = keys.select(*[F.col(k).cast(types[k]).alias(k) for k in manifest.keys])
    wanted = [r.bucket for r in typed.select(bucket_of(manifest.keys, manifest.buckets).alias("bucket")).distinct().collect()]  # at most all buckets
    rows = read_entries(spark, path, wanted).join(typed, manifest.keys, "left_semi")
    return rows.filter(F.col("_image").isNotNull()).select("_image.*")


def merge_parts(spark: SparkSession, path: str, merge_after: int = 1) -> int:
    """Merge the buckets with more than ``merge_after`` parts, and no others; returns how many there were.

    Not to be run beside a job that writes: whoever publishes later then fails.
    """
    old = read_manifest(spark, path)
    crowded = sum(len(p) > max(1, merge_after) for p in old.parts.values()) if old else 0
    if crowded:
        publish(spark, path, _next(spark, path, old, None, merge_after))
    return crowded


def rebucket(spark: SparkSession, path: str, buckets: int) -> None:
    """Deal the table into another number of buckets, when they have grown too large."""
    old = read_manifest(spark, path)
    if old.tables:
        raise ValueError("the buckets of a store of many tables are numbered by table")
    rows = read_entries(spark, path).withColumn("bucket", bucket_of(old.keys, buckets))
    name = f"v={old.version + 1}"
    parts = {b: [name] for b in _write(rows, f"{path}/data/{name}")}
    publish(spark, path, replace(old, version=old.version + 1, buckets=buckets, parts=parts))


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the parts that the manifest names no more; returns how many. Run it when no reader still works on them."""
    manifest = read_manifest(spark, path)
    used = {(part, b) for b, parts in manifest.parts.items() for part in parts}
    files, data = _file_system(spark, f"{path}/data")
    dropped = 0
    for version in files.listStatus(data):
        part, kept = version.getPath().getName(), 0
        for status in files.listStatus(version.getPath()):
            name = status.getPath().getName()
            if name.startswith("bucket="):
                if (part, int(name.split("=")[1])) in used:
                    kept += 1
                else:
                    files.delete(status.getPath(), True)
                    dropped += 1
        if not kept:
            files.delete(version.getPath(), True)
    return dropped
