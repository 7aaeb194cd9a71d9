"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Rows with equal texts form a group and share a shard. A group goes where the dot
product of its size vector with the shard's residual capacity is highest, among the
shards with room for its bytes.

Groups that hold a noticeable share of a shard are placed first, all together: there
are at most ``3 * n_shards * LARGE`` of them by definition, however many rows there
are. All others are dealt by hash into blocks, and each block is packed alone into its
share of what is left of every shard. A group larger than a whole shard is cut into
pieces by hash of the id, as no shard could take it.

Defined cases: a null text counts as empty, and empty texts are one group. Repeated rows
are rows of one group and keep a slot each. A null id is placed like any other. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import WORD, parts, stash, text_of

#: A group is large from this part of a shard's capacity on.
LARGE = 64
#: Weight of bytes, tokens and rows in the dot product.
WEIGHTS = (0.6, 0.2, 0.2)
DIMS = ["bytes", "tokens", "rows"]
GROUPS_PER_BLOCK = 4096
ROWS_PER_CHUNK = 20_000
#: Room over the mean that a shard may take in bytes.
SLACK = 1.0005


def place(sizes: np.ndarray, residual: np.ndarray, scale: np.ndarray, weights=WEIGHTS) -> np.ndarray:
    """A shard for each row of ``sizes`` (largest bytes first); ``residual`` is used up."""
    out = np.empty(len(sizes), np.int32)
    w = np.asarray(weights) / np.maximum(scale, 1) ** 2
    for i in np.argsort(-sizes[:, 0], kind="stable"):
        fits = residual[:, 0] >= sizes[i, 0]
        if fits.any():
            score = np.where(fits, residual @ (w * sizes[i]), -np.inf)
        else:
            score = residual[:, 0]
        out[i] = best = int(score.argmax())
        residual[best] -= sizes[i]
    return out


def _sizes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("bytes"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )


def assign_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, bytes, tokens, text_crc32, shard, slot.

    ``bytes`` is the UTF-8 length plus 8. Slots count from 0 in each shard.
    """
    spark = docs.sparkSession
    units = stash(_sizes(docs, id_col, text_col), "shard-sizes")
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = units.agg(*sums).first()
    total = np.array([total[d] or 0 for d in DIMS], float)
    room = total / n_shards

    # at most 3 * n_shards groups are larger than a shard
    too_large = F.greatest(*[F.ceil(F.col(d) / F.lit(float(max(room[i], 1)))) for i, d in enumerate(DIMS)])
    groups = units.groupBy("digest").agg(*sums)
    cut = groups.withColumn("pieces", F.when(too_large > 1, too_large * 8).cast("int")).filter("pieces is not null")
    cut = spark.createDataFrame(
        [(bytes(r.digest), r.pieces) for r in cut.select("digest", "pieces").collect()], "digest binary, pieces int"
    )
    piece = F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).cast("int")
    units = units.join(F.broadcast(cut), "digest", "left").withColumn("piece", piece).drop("pieces")
    groups = stash(units.groupBy("digest", "piece").agg(*sums), "shard-groups")

    is_large = F.greatest(*[F.col(d) / F.lit(float(max(room[i], 1))) for i, d in enumerate(DIMS)]) >= 1.0 / LARGE
    large = groups.filter(is_large).orderBy("digest", "piece").toPandas()
    residual = np.tile(room, (n_shards, 1))
    residual[:, 0] *= SLACK
    large["shard"] = place(large[DIMS].to_numpy(float), residual, room)
    large_rows = [(bytes(d), int(p), int(s)) for d, p, s in zip(large["digest"], large["piece"], large["shard"], strict=True)]
    placed = spark.createDataFrame(large_rows, "digest binary, piece int, shard int")

    left = np.maximum(residual, 0)
    share = left / np.maximum(left.sum(axis=0), 1)

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["digest", "piece"], ignore_index=True)
        sizes = block[DIMS].to_numpy(float)
        own = share * sizes.sum(axis=0)
        own[:, 0] *= SLACK
        block["shard"] = place(sizes, own, own.mean(axis=0))
        return block[["digest", "piece", "shard"]]

    small = groups.filter(~is_large)
    n_blocks = parts(groups.count(), GROUPS_PER_BLOCK)
    packed = (
        small.withColumn("block", F.pmod(F.xxhash64("digest", "piece"), F.lit(n_blocks)))
        .groupBy("block")
        .applyInPandas(pack, "digest binary, piece int, shard int")
    )
    n_chunks = parts(int(total[2]), ROWS_PER_CHUNK)
    chunk = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(n_chunks)).cast("int")
    # rows of large groups meet the few placed groups where they are; only the others are shuffled
    marked = units.join(F.broadcast(placed), ["digest", "piece"], "left")
    others = marked.filter("shard is null").drop("shard").join(packed, ["digest", "piece"])
    placed_rows = stash(marked.filter("shard is not null").unionByName(others).withColumn("chunk", chunk), "shard-rows")
    return with_slots(placed_rows).select("doc_id", "bytes", "tokens", "text_crc32", "shard", "slot")


def with_slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard: by chunk, then by id, without one task per shard."""
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "digest")
    numbered = rows.withColumn("row", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "chunk"]).withColumn("slot", (F.col("start") + F.col("row")).cast("long"))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    rows = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
    return rows.select(
        "doc_id",
        F.col("bytes").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )
