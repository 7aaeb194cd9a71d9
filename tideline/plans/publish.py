"""The publish jobs: change frames to routed topic records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.operators.envelope import Temporal, image_texts, normalize_envelope
from tideline.operators.routing import hash_partition, registry_for, registry_partition
from tideline.sinks.topics import ordered_frame, topic_frame


def publish_by_key(
    env: DataFrame, key_map: DataFrame | dict[str, str], n: int, temporal: Temporal | None = None, order_by: list[str] | None = None
) -> DataFrame:
    """``value`` and ``partition``, so that all changes of a key share a partition; with ``order_by`` also ``sequence``.

    The images stay typed until the text is written; nothing is parsed again. A key is hashed as the
    envelope shows it, so readers of the text find the same partition.
    """
    routed = hash_partition(image_texts(normalize_envelope(env, temporal), temporal), key_map, n)
    return ordered_frame(routed, order_by) if order_by else topic_frame(routed)


def publish_by_registry(
    env: DataFrame, registry: DataFrame, topic: str, temporal: Temporal | None = None
) -> DataFrame:
    """``value`` and ``partition``, with one registered partition per table."""
    return topic_frame(registry_partition(normalize_envelope(env, temporal), registry_for(registry, topic)))
