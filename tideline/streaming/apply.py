"""Continuous changelog apply on a table of files.

Layout under the table path: ``changes/batch_id=N`` holds, per changed key of a
micro-batch, its last image (null for a removed key); ``compacted/upto=N``
holds the same over all batches up to N. A repeated batch overwrites its own
folder, so replays after a failure change nothing. Removed keys are kept, so
that a late change cannot bring one back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline import model as m
from tideline.operators.changelog import keyed_images, last_images, remove_rows
from tideline.sinks.rows import delete_rows_jdbc, insert_rows_jdbc, merge_rows_jdbc, versioned_rows


def write_batch(env: DataFrame, batch_id: int, path: str, keys: list[str], order_by: list[str]) -> None:
    """Fold one micro-batch to its last image per key and store it."""
    folded = last_images(keyed_images(env, keys, order_by), keys)
    folded.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def write_base(snapshot: DataFrame, changes: DataFrame, path: str, keys: list[str], order_by: list[str]) -> None:
    """Store the images of a snapshot as the first compaction, older than any change."""
    if _finished(snapshot.sparkSession, f"{path}/compacted", "upto"):
        return
    order = changes.select(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]).alias("_order")).schema["_order"].dataType
    images = snapshot.select(*[F.col("after")[k].alias(k) for k in keys], F.col("after").alias("_image"), F.lit(None).cast(order).alias("_order"))
    images.write.mode("overwrite").parquet(f"{path}/compacted/upto=-1")


def start_apply(
    stream: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply a stream of changes to the table at ``path``.

    The checkpoint belongs to the path and lives below it by default: batches
    written under another checkpoint would be overwritten, so a path that holds
    some is refused. A key column named ``batch_id`` is not possible.
    """
    checkpoint = checkpoint or f"{path}/_checkpoint"
    spark = stream.sparkSession
    own_checkpoint(spark, f"{path}/changes", checkpoint)
    writer = stream.writeStream.foreachBatch(lambda env, i: write_batch(env, i, path, keys, order_by))
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def apply_batch_jdbc(
    env: DataFrame, url: str, table: str, staging: str, keys: list[str], order_by: list[str], **options: str
) -> None:
    """Bring a JDBC table up to date with one micro-batch.

    Per key only the last image counts: the key's row is deleted, and inserted
    again unless the key was removed. A repeated batch gives the same table.
    The database keeps no order, so batches must bring a key's changes in order.
    """
    mutation = options.pop("mutation", False)
    folded = last_images(keyed_images(env, keys, order_by), keys).persist()
    try:
        delete_rows_jdbc(folded.select(*keys), url, table, staging, mutation, **options)
        kept = folded.filter(F.col("_image").isNotNull())
        insert_rows_jdbc(kept.select(F.lit(m.INSERT).alias("row_kind"), "_image.*"), url, table, **options)
    finally:
        folded.unpersist()


def start_apply_jdbc(
    stream: DataFrame, checkpoint: str, trigger: dict | None = None, **target
) -> StreamingQuery:
    """Apply a stream of changes to a JDBC table; ``target`` as in :func:`apply_batch_jdbc`."""
    writer = stream.writeStream.foreachBatch(lambda env, _: apply_batch_jdbc(env, **target))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def apply_versions_jdbc(
    env: DataFrame, batch_id: int, url: str, table: str, staging: str, keys: list[str], version: str, **options: str
) -> None:
    """Bring a JDBC table up to date with one micro-batch, whatever order batches come in.

    ``version`` is a whole-number column of the changes that grows with a key's changes, such as a log position. The table has it in a
    column of its own and marks removed keys (``sinks.rows.VERSION``, ``REMOVED``). The database compares versions before
    it deletes or inserts. Each batch has its own staging table, so a delete that is still at
    work never reads the keys of the next batch.
    """
    folded = last_images(keyed_images(env, keys, [version]), keys).withColumn("_version", F.col("_order.o0"))
    merge_rows_jdbc(versioned_rows(folded, keys), url, table, f"{staging}_{batch_id}", keys, **options)


def start_apply_versions_jdbc(
    stream: DataFrame, checkpoint: str, trigger: dict | None = None, **target
) -> StreamingQuery:
    """Apply a stream of changes to a versioned JDBC table; ``target`` as in :func:`apply_versions_jdbc`."""
    writer = stream.writeStream.foreachBatch(lambda env, i: apply_versions_jdbc(env, i, **target))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _present(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def own_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a path that holds batches while the checkpoint is new."""
    if _present(spark, path) and not _present(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")


def _finished(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Ids of the ``name=…`` folders that were written to the end."""
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    ids = [int(found.split("=")[1]) for found in names if found.startswith(f"{name}=")]
    return sorted(i for i in ids if _present(spark, f"{folder}/{name}={i}/_SUCCESS"))


def _entries(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None, int]:
    """The newest compaction, the batches after it, and the last batch.

    A batch that was cut off while it was written is left for its repetition. Only the folders of later
    batches are listed, however many there were before.
    """
    batches = _finished(spark, f"{path}/changes", "batch_id")
    compactions = _finished(spark, f"{path}/compacted", "upto")
    upto = compactions[-1] if compactions else -1
    later = [i for i in batches if i > upto]
    last = later[-1] if later else upto
    if not compactions and not later:
        raise ValueError(f"{path} holds no finished batch")
    compacted = spark.read.parquet(f"{path}/compacted/upto={upto}") if compactions else None
    changes = spark.read.parquet(*[f"{path}/changes/batch_id={i}" for i in later]) if later else None
    return compacted, changes, last


def _folded(compacted: DataFrame | None, later: DataFrame | None, keys: list[str]) -> list[DataFrame]:
    """Parts that together hold the last image of every key.

    Compacted rows without a later change pass as they are: they are only anti-joined with the later
    keys, and not shuffled where these are few.
    """
    if later is None:
        return [compacted]
    if compacted is None:
        return [last_images(later, keys)]
    new = last_images(later, keys)
    changed = later.select(*keys).distinct()
    touched = compacted.join(changed, keys, "left_semi")
    return [remove_rows(compacted, changed), last_images(touched.unionByName(new), keys)]


def read_applied(spark: SparkSession, path: str, keys: list[str], base: DataFrame | None = None) -> DataFrame:
    """The current rows of the table; ``base`` rows count as older than all changes.

    Right after a compaction nothing has to be folded, nor shuffled.
    """
    compacted, later, _ = _entries(spark, path)
    parts = _folded(compacted, later, keys)
    folded = reduce(DataFrame.unionByName, parts)
    rows = folded.filter(F.col("_image").isNotNull()).select("_image.*")
    if base is None:
        return rows
    for part in (compacted, later):
        if part is not None:
            base = remove_rows(base, part.select(*keys) if part is compacted else part.select(*keys).distinct())
    return base.select(*rows.columns).unionByName(rows)


def compact_applied(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Fold all finished batches into one compaction; returns the last batch it holds.

    Running jobs are not disturbed: batches are only added, and readers switch
    to the compaction once it is written.
    """
    compacted, later, last = _entries(spark, path)
    if later is not None:
        folded = reduce(DataFrame.unionByName, _folded(compacted, later, keys))
        folded.write.mode("overwrite").parquet(f"{path}/compacted/upto={last}")
    return last


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete the batches and older compactions that the newest compaction replaces.

    Run it when no reader still works on them.
    """
    compactions = _finished(spark, f"{path}/compacted", "upto")
    replaced = [f"compacted/upto={i}" for i in compactions[:-1]]
    replaced += [
        f"changes/batch_id={i}" for i in _finished(spark, f"{path}/changes", "batch_id") if i <= compactions[-1]
    ]
    for folder in replaced:
        files, target = _file_system(spark, f"{path}/{folder}")
        files.delete(target, True)
