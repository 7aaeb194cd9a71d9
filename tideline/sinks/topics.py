"""Topic sink: value only, with an explicit partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.positions import with_position


def topic_frame(df: DataFrame) -> DataFrame:
    """The columns Spark's Kafka sink takes: ``value`` and, if routed, ``partition``."""
    columns = [df["value"].cast("string").alias("value")]
    if "partition" in df.columns:
        columns.append(df["partition"].cast("int").alias("partition"))
    return df.select(*columns)


def sink_options(bootstrap: str, topic: str, opts: dict[str, str] | None = None) -> dict[str, str]:
    extra = {k if k.startswith("kafka.") else f"kafka.{k}": v for k, v in (opts or {}).items()}
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, **extra}


def write_frame(frame: DataFrame, bootstrap: str, topic: str, opts: dict[str, str] | None = None) -> None:
    """Write a topic frame; a task sends its rows in the order in which it has them."""
    frame.write.format("kafka").options(**sink_options(bootstrap, topic, opts)).save()


def write_topic(df: DataFrame, bootstrap: str, topic: str, opts: dict[str, str] | None = None) -> None:
    write_frame(topic_frame(df), bootstrap, topic, opts)


def in_order(df: DataFrame, order_by: list[str], partitions: int) -> DataFrame:
    """The topic frame, dealt so that one task has all rows of a topic partition, sorted by ``order_by``.

    A topic partition has one end, to which its rows have to be added one after the other. The sort spills, so its
    memory is bounded. Rows without a partition come first and may be sent in any order.
    """
    dealt = df.repartition(partitions, "partition").sortWithinPartitions("partition", *order_by)
    return topic_frame(dealt)


def ordered_frame(df: DataFrame, order_by: list[str]) -> DataFrame:
    """The topic frame with ``sequence``: the 0-based rank of each row in its topic partition, by ``order_by``.

    The rows are sorted by ranges of partition and position, so a hot topic partition is split over many tasks.
    """
    order = [F.col(c).alias(f"_order_{i}") for i, c in enumerate(order_by)]
    routed = df.select(F.col("value").cast("string").alias("value"), F.col("partition").cast("int").alias("partition"), *order)
    ranked = with_position(routed, ["partition", *[f"_order_{i}" for i in range(len(order))]], "_place")
    firsts = ranked.groupBy(F.col("partition").alias("_of")).agg(F.min("_place").alias("_first"))
    joined = ranked.join(firsts, F.col("partition").eqNullSafe(F.col("_of")))  # a row per topic partition
    return joined.select("value", "partition", (F.col("_place") - F.col("_first")).alias("sequence"))
