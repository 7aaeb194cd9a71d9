"""Connected components of a table of edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stash


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``comp`` (the smallest node reachable) of every node with an edge.

    Each round takes the smallest label around a node, then that label's own label, so
    long chains shrink by halves. Labels are written to the shared folder each round.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    both = stash(both.union(both.select("v", "u")).distinct(), "edges")
    labels = stash(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("comp")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        closer = labels.join(seen, "node", "left").select("node", "comp", F.least("comp", "near").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("comp").alias("far"))
        moved = closer.join(jump, "near", "left").select("node", F.least("near", "far").alias("comp"), F.col("comp").alias("was"))
        moved = stash(moved, "labels")
        labels = moved.select("node", "comp")
        if moved.filter("comp <> was").limit(1).count() == 0:
            return labels
