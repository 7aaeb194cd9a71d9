"""Debug sink: row-kind rows as text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.positions import with_position


def debug_lines(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``line``: the row as ``+I[v1, v2, …]``, with the ``keep`` columns beside it."""
    keep = keep or []
    fields = [c for c in rows.columns if c != "row_kind" and c not in keep]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in fields]
    line = F.concat(F.col("row_kind"), F.lit("["), F.concat_ws(", ", *texts), F.lit("]"))
    return rows.select(*keep, line.alias("line"))


def debug_sink(rows: DataFrame, path: str, order_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Write the lines of all rows to a folder of text files; limit ``rows`` for fewer.

    With ``order_by`` the files, by name, and the lines in them are in that order: rows are sorted by ranges, in many
    tasks. The lines are without these columns.
    """
    lines = debug_lines(rows, order_by)
    if order_by:
        lines = lines.orderBy(*order_by).select("line")
    lines.write.mode(mode).text(path)


def read_debug(spark: SparkSession, path: str) -> DataFrame:
    """``line`` and ``position``, from 0, of lines written in order: by batch, file and place in the file."""
    name = F.col("_metadata.file_name")
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.coalesce(F.regexp_extract("_metadata.file_path", r"/batch_id=(\d+)/", 1).try_cast("bigint"), F.lit(-1)).alias("_batch"),
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("bigint").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),  # grows within a block
    )
    return with_position(lines, ["_batch", "_file", "_block", "_line"]).select("position", "line")
