"""Helpers shared by the text operators."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tideline.session import fresh_path

#: A word: a longest run of bytes other than the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, name: str, path: str | None = None, compression: str = "snappy", **options: int) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and every
    executor can read the rows again after another one is lost. The shuffles of the write go with its end."""
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stashed folders that nothing still to run reads: what was made of them is on the driver or stashed itself."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_of(col: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def remainder(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``n``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n), F.lit(0)).cast("int")


#: Texts, and bytes, per Arrow batch where whole texts go to Python; a longer row is a batch of its own.
TEXTS_PER_BATCH, BYTES_PER_BATCH = 1_000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size, as texts are long: a batch is held in Spark and in Python.

    A smaller size that is set already stays.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH), ("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)):
        if not 0 < int(re.sub(r"\D", "", spark.conf.get(name))) <= most:
            spark.conf.set(name, most)


def parts(rows: int, per_part: int) -> int:
    """How many blocks of about ``per_part`` rows; at least one."""
    return max(1, math.ceil(rows / per_part))


#: Bits of the filter that ``id_filter`` builds: 8 MB, however many ids there are.
FILTER_BITS = 1 << 26


class IdFilter:
    """Tells of every id in ``ids`` that it may be one of them, and of few others.

    It keeps rows that a join would drop from being shuffled. The filter has a fixed size; with very
    many ids it lets more rows pass, never fewer, so a join still has to decide.
    """

    def __init__(self, ids: DataFrame, col: str = "doc_id"):
        rows = (
            ids.select(self.place(col).alias("p"))
            .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
            .collect()  # at most FILTER_BITS / 32768 rows of 4 KB
        )
        bits = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
        for r in rows:
            if r.bucket > 0:  # bucket 0 holds place 0 alone, which always passes below
                start = (r.bucket - 1) * 4096
                bits[start : start + len(r.bits)] = np.frombuffer(r.bits, np.uint8)
        self.bits = ids.sparkSession.sparkContext.broadcast(bits)

    @staticmethod
    def place(col: str = "doc_id") -> Column:
        return F.pmod(F.xxhash64(col), F.lit(FILTER_BITS))

    def holds(self, places: np.ndarray) -> np.ndarray:
        # bucket k + 1 holds the places k * 32768 + 1 to (k + 1) * 32768
        before = np.maximum(places - 1, 0)
        held = self.bits.value[before // 32768 * 4096 + before % 32768 // 8] >> (before % 8)
        return (places == 0) | (held & 1).astype(bool)

    def column(self, col: str = "doc_id") -> Column:
        """The answer as a column; a stage that has its own Python code had better call ``holds`` there."""
        holds = self.holds

        @F.pandas_udf(BooleanType())
        def maybe(p: pd.Series) -> pd.Series:
            return pd.Series(holds(p.to_numpy()))

        return maybe(self.place(col))


def byte_slices(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in stretches of about ``limit`` bytes of text; a longer text is one of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
