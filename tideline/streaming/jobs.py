"""Streams of envelopes: from files, to topics, files and the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.changelog import fan_out
from tideline.operators.envelope import parse_envelope
from tideline.sinks.debug import debug_lines, debug_sink
from tideline.sinks.rows import encode_rows
from tideline.sinks.topics import in_order, sink_options, topic_frame, write_frame
from tideline.streaming.apply import own_checkpoint
from tideline.streaming.commits import commit, read_commits

ONCE = {"availableNow": True}


def envelope_stream(
    spark: SparkSession,
    path: str,
    image: T.StructType | str,
    source: T.StructType | str = "db STRING, table STRING, ts_ms BIGINT, pos BIGINT",
    max_files: int = 1000,
) -> DataFrame:
    """Change frame from a growing folder of envelope lines, wrapped or bare."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return parse_envelope(lines, image, source)


def start_topic(
    df: DataFrame,
    bootstrap: str,
    topic: str,
    checkpoint: str,
    opts: dict[str, str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write routed envelopes to a topic; delivery is at least once."""
    writer = topic_frame(df).writeStream.format("kafka").options(**sink_options(bootstrap, topic, opts))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def start_topic_in_order(
    df: DataFrame,
    order_by: list[str],
    partitions: int,
    bootstrap: str,
    topic: str,
    checkpoint: str,
    opts: dict[str, str] | None = None,
    trigger: dict | None = None,
    write: Callable[[DataFrame, str, str, dict[str, str] | None], None] = write_frame,
) -> StreamingQuery:
    """Write routed envelopes to a topic of ``partitions`` partitions, each in order of position within a micro-batch.

    Batches follow each other, so a source that brings a key's changes in order is published in order. After
    a failure a batch is sent again as a whole: delivery is at least once.
    """
    writer = df.writeStream.foreachBatch(lambda rows, _: write(in_order(rows, order_by, partitions), bootstrap, topic, opts))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def start_envelope_files(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the ``value`` texts to a folder of line files, exactly once."""
    writer = df.select("value").writeStream.format("text").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def start_rows(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append ``+I``/``+U`` rows to a folder of JSON-lines files, exactly once."""
    writer = encode_rows(rows).writeStream.format("text").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def start_fan_out(
    env: DataFrame, path: str, checkpoint: str, tables: list[str] | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Write every table's changes to its own folder, batch by batch.

    A batch is committed once all its tables are written: :func:`~tideline.streaming.commits.read_fan_out` shows whole batches only. A
    batch that was cut off overwrites its own ``batch_id=…`` folder when it is repeated. The checkpoint belongs to the path:
    under another one, batches would replace each other, so a path that holds some is refused.
    """
    own_checkpoint(env.sparkSession, path, checkpoint)

    def write(rows: DataFrame, batch: int) -> None:
        if batch <= read_commits(rows.sparkSession, path).last:
            return
        fan_out(rows, f"{path}/batch_id={batch}", tables, "overwrite")
        commit(rows.sparkSession, path, batch, rows.schema)

    writer = env.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def start_debug(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, order_by: list[str] | None = None
) -> StreamingQuery:
    """Append the row-kind lines of all rows to a folder of text files, exactly once.

    With ``order_by`` each micro-batch is a ``batch_id=…`` folder of files in that order, as by :func:`~tideline.sinks.debug.debug_sink`.
    """
    if order_by:
        own_checkpoint(rows.sparkSession, path, checkpoint)
        writer = rows.writeStream.foreachBatch(lambda some, i: debug_sink(some, f"{path}/batch_id={i}", order_by, "overwrite"))
    else:
        writer = debug_lines(rows).select("line").writeStream.format("text").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()
