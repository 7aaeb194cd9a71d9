"""Dense positions over a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import use_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def with_position(df: DataFrame, order_by: list[str | Column], name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row in ``order_by``, which must be a total order.

    The sort is range partitioned. Its result is checkpointed, because the
    per-partition counts and the rows must come from the same run of it.
    """
    use_checkpoint_dir(df.sparkSession)
    rows = (
        df.orderBy(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
        .checkpoint()
    )
    # one row per sort partition, so the window below sees a bounded input
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(
        F.expr("sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"),
        F.lit(0),
    )
    offsets = counts.select("_part", before.alias("_before"))
    return (
        rows.join(F.broadcast(offsets), "_part")  # a row per sort partition
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_part", "_row", "_before")
    )
