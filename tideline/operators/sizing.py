"""Broadcast behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20


def checked_broadcast(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, known_rows: int | None = None
) -> DataFrame:
    """``side`` with a broadcast hint when its size is within the bounds.

    At most ``max_rows + 1`` rows are fetched to decide. A small side is replaced
    by those rows, so its plan runs once. A larger one comes back unhinted: the
    join then shuffles and adaptive execution splits skewed partitions. Nothing
    is fetched where the caller knows the row count.
    """
    if known_rows is not None:
        return F.broadcast(side) if known_rows <= max_rows else side
    head = side.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows or head.nbytes > BROADCAST_BYTES:
        return side
    return F.broadcast(side.sparkSession.createDataFrame(head, schema=side.schema))
