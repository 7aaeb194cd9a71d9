"""Topics: reading, offsets for a time, replay from a time."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.sizing import checked_broadcast

# up to so many partitions, replay positions are a filter instead of a join
FILTER_PARTITIONS = 64


def topic_options(
    bootstrap: str,
    topic: str,
    max_offsets: int | None = None,
    starting: str | None = None,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for Spark's Kafka source; ``security`` keys get the ``kafka.`` prefix."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if starting is not None:
        options["startingOffsets"] = starting
    for key, value in (security or {}).items():
        options[key if key.startswith("kafka.") else f"kafka.{key}"] = value
    return options


def replay_options(since: dt.datetime | None = None, hours: float = 1.0, unmatched: str = "latest") -> dict[str, str]:
    """Options that start each partition at the first record of the last hour."""
    if since is None:
        since = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=hours)
    return {
        "startingTimestamp": str(int(since.timestamp() * 1000)),
        "startingOffsetsByTimestampStrategy": unmatched,
    }


def read_topic(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    max_offsets: int | None = 1_000_000,
    security: dict[str, str] | None = None,
    replay: dict[str, str] | None = None,
    starting: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Records of a topic with ``value`` as text; fetches are bounded per trigger.

    ``starting`` is ``earliest``, ``latest`` or the text of :func:`starting_offsets`;
    ``replay`` comes from :func:`replay_options`.
    """
    options = topic_options(bootstrap, topic, max_offsets if streaming else None, starting, security)
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**options, **(replay or {})).load()
    return raw.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def _first_offsets(records: DataFrame, t: dt.datetime | str) -> DataFrame:
    # the time filter reaches the scan, so only files from t on are read
    moment = F.lit(str(t)).cast(records.schema["timestamp"].dataType)
    return (
        records.filter(F.col("timestamp") >= moment)
        .groupBy("topic", "partition")
        .agg(F.min("offset").alias("offset"))
    )


def offsets_for_times(
    records: DataFrame, t: dt.datetime | str, partitions: dict[str, int] | None = None
) -> DataFrame:
    """Per partition the earliest offset whose timestamp is at or after ``t``.

    Null where no record qualifies. ``partitions`` gives the partition count of
    every topic; without it the partitions are those that hold any record, which
    takes a scan of all of them.
    """
    found = _first_offsets(records, t)
    no_offset = F.lit(None).cast("bigint").alias("offset")
    if partitions is None:
        listed = records.select("topic", "partition", no_offset).distinct()
    else:
        kind = records.schema["partition"].dataType
        ranges = [
            records.sparkSession.range(count).select(
                F.lit(topic).alias("topic"), F.col("id").cast(kind).alias("partition"), no_offset
            )
            for topic, count in partitions.items()
        ]
        listed = reduce(DataFrame.unionByName, ranges)
    return found.unionByName(listed).groupBy("topic", "partition").agg(F.min("offset").alias("offset"))


def replay_from(
    records: DataFrame,
    t: dt.datetime | str,
    unmatched: str = "latest",
    committed: DataFrame | None = None,
) -> DataFrame:
    """Whole records from the offset found for ``t`` on, partition by partition.

    A partition without such an offset keeps its position: the one in
    ``committed`` (topic, partition, offset) when given, else its end
    (``latest``, no rows) or its start (``earliest``, all rows). A null offset in
    ``committed`` is no position.
    """
    if unmatched not in ("latest", "earliest"):
        raise ValueError("unmatched must be 'latest' or 'earliest'")
    keys = ["topic", "partition"]
    seek = _first_offsets(records, t)
    if committed is not None:
        held = committed.select(*keys, F.col("offset").alias("_held"))
        seek = seek.join(held, keys, "full").select(*keys, F.coalesce("offset", "_held").alias("offset"))
    seek = seek.filter(F.col("offset").isNotNull()).withColumnRenamed("offset", "_seek")
    side = checked_broadcast(seek)
    kept = records.columns
    if side is not seek:
        found = side.limit(FILTER_PARTITIONS + 1).collect()
        if len(found) <= FILTER_PARTITIONS:
            return records.filter(_reached(found, unmatched)).select(*kept)
        if unmatched == "latest":
            records = records.filter(F.col("offset") >= side.agg(F.min("_seek")).first()[0])
    joined = records.join(side, keys, "left" if unmatched == "earliest" else "inner")
    return joined.filter(F.coalesce(F.col("offset") >= F.col("_seek"), F.lit(True))).select(*kept)


def _reached(found: list, unmatched: str) -> Column:
    """The positions of a few partitions as one filter, which reaches the scan."""
    offset = F.col("offset")
    at = [(F.col("topic") == r.topic) & (F.col("partition") == r.partition) for r in found]
    passed = reduce(or_, [p & (offset >= r["_seek"]) for p, r in zip(at, found)], F.lit(False))
    if unmatched == "earliest":
        return passed | ~reduce(or_, at, F.lit(False))
    return passed & (offset >= min((r["_seek"] for r in found), default=0))


def starting_offsets(offsets: DataFrame, topic: str) -> str:
    """Offsets of one topic as the JSON text of Spark's ``startingOffsets``.

    -1 stands for the end of a partition. One row per partition of the topic.
    """
    rows = offsets.filter(F.col("topic") == topic).select("partition", F.coalesce("offset", F.lit(-1))).collect()
    return json.dumps({topic: {str(p): o for p, o in rows}}, sort_keys=True)
