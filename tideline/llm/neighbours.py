"""Nearest neighbours by collision counting on single projections.

Each vector gets ``m`` random projections. A block of base vectors keeps one sorted array per
projection. A query puts a window around its own value in every array and counts, for each base
vector, in how many windows it lies. The windows widen together, level by level (virtual
rehashing: no array is built again). A vector
that collides in at least ``threshold`` of the arrays is verified by its exact inner product. A query
stops once enough vectors are verified, or its windows hold the whole block.

For inner products, base vectors get one more component that brings all to the same
length, and queries a zero there; then the nearest by angle is the largest by product.

Equal vectors are one class and are searched once. Only the smallest ``k + 1`` ids of a class can be
among anyone's nearest ``k``; they are found by ranks per salted part of a class, then per class, so
a class with a third of all rows is not one task's. Base and queries are cut into
blocks, and every pair of blocks is one group of bounded size; each base row is indexed.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or
have another length than most take no part. Null ids take no part. Repeated rows of one id count
as one. With fewer than ``k`` candidates all that are found are returned. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import parts, stash

PROJECTIONS = 96
#: Part of the projections in which a vector must collide.
THRESHOLD = 0.85
#: Vectors a query verifies in a block, as a part of the block, besides fifteen times ``k``.
VERIFY = 0.08
#: Half-width of the first windows, in standard deviations of a projection, and its growth.
START, GROW = 1.25, 1.06
#: Places of a sorted array with a stored set of what lies before.
STEPS = 64
BASE_BLOCK, QUERY_BLOCK = 16_384, 2_048
SALTS = 64
SEED = 11


class Block:
    """Sorted projections of some base vectors.

    Each sorted array also keeps, at ``STEPS`` evenly spaced places, the set of all vectors before
    that place as bits. A window is the difference of two such sets, rounded outwards, and the
    collisions of all vectors with many queries are counted in bit planes.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top_norm: float, m: int = PROJECTIONS):
        self.ids, self.vectors, self.m = ids, vectors, m
        n = len(ids)
        fill = np.sqrt(np.maximum(top_norm**2 - (vectors**2).sum(axis=1), 0))
        self.axes = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, m))
        values = (np.column_stack([vectors, fill]) @ self.axes) / top_norm
        order = values.argsort(axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)
        cuts = np.arange(STEPS + 1) * n // STEPS
        self.before = np.zeros((m, STEPS + 1, -(-n // 64)), np.uint64)
        rank = np.empty(n, np.int64)
        for i in range(m):
            rank[order[:, i]] = np.arange(n)
            bits = np.packbits(rank < cuts[:, None], axis=1, bitorder="little")
            self.before[i].view(np.uint8)[:, : bits.shape[1]] = bits

    def _collisions(self, low: np.ndarray, high: np.ndarray, least: int) -> np.ndarray:
        """For each query, the vectors (as bits) in at least ``least`` of its windows."""
        planes: list[np.ndarray] = []
        for i in range(self.m):
            carry = self.before[i][high[:, i]] ^ self.before[i][low[:, i]]
            for p in range(len(planes)):
                planes[p], carry = planes[p] ^ carry, planes[p] & carry
            if (i + 1) & i == 0:  # the count can reach one more bit
                planes.append(carry)
        more, same = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
        for p in range(len(planes) - 1, -1, -1):
            if least >> p & 1:
                same &= planes[p]
            else:
                more |= same & planes[p]
                same &= ~planes[p]
        return more | same

    def search(self, queries: np.ndarray, k: int, threshold: float = THRESHOLD, verify: float = VERIFY):
        """For each query, positions and exact products of the best ``k`` found."""
        n = len(self.ids)
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        at = unit @ self.axes[:-1]
        enough, least = min(n, 15 * k + int(np.ceil(verify * n))), int(np.ceil(threshold * self.m))
        out = [None] * len(queries)
        for first in range(0, len(queries), 64):
            going, width = np.arange(first, min(first + 64, len(queries))), START
            while len(going):
                low = np.stack([np.searchsorted(self.sorted[i], at[going, i] - width, "left") for i in range(self.m)], axis=1)
                high = np.stack([np.searchsorted(self.sorted[i], at[going, i] + width, "right") for i in range(self.m)], axis=1)
                whole = (high - low).min(axis=1) >= n
                hits = self._collisions(low * STEPS // n, -(-high * STEPS // n), least)
                counts = np.bitwise_count(hits).sum(axis=1)
                done = (counts >= enough) | whole
                for j in np.flatnonzero(done):
                    found = np.arange(n) if whole[j] else np.flatnonzero(np.unpackbits(hits[j].view(np.uint8), bitorder="little", count=n))
                    out[going[j]] = self._verify(found, queries[going[j]], k)
                going, width = going[~done], width * GROW
        return out

    def _verify(self, found: np.ndarray, query: np.ndarray, k: int):
        scores = self.vectors[found] @ query
        if len(found) > k:  # equal scores at the edge all stay until ids decide
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= edge], scores[scores >= edge]
        order = np.lexsort((self.ids[found], -scores))[:k]
        return found[order], scores[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(fine)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<float>").alias("embedding"))
    usual = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("embedding") == (usual.d if usual else 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows that ``is_query`` (over vec_id) picks."""
    rows = stash(usable(vectors, id_col, vector_col).withColumn("h", F.xxhash64("embedding")), "vectors")
    salted = Window.partitionBy("h", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy("vec_id")
    first = rows.withColumn("r", F.dense_rank().over(salted)).filter(F.col("r") <= k + 1).drop("r").distinct()
    whole = Window.partitionBy("h", "embedding").orderBy("vec_id")
    few = first.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= k + 1)
    classes = stash(few.groupBy("h", "embedding").agg(F.min("vec_id").alias("cls"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    queries = rows.filter(is_query).distinct().join(classes.select("h", "embedding", "cls"), ["h", "embedding"]).select("vec_id", "cls")
    queries = stash(queries.withColumnRenamed("vec_id", "query_id"), "queries")
    asked = stash(classes.join(queries.select("cls").distinct(), "cls", "left_semi"), "asked")
    size = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("s")).first()
    n_base, n_query = parts(size.n, BASE_BLOCK), parts(asked.count(), QUERY_BLOCK)
    top_norm = float(np.sqrt(size.s or 1.0)) * (1 + 1e-9)

    def dealt(frame: DataFrame, own: str, n: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("cls"), F.lit(n)).cast("int")
        return frame.select("cls", "embedding", block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    def search(key, base: pa.Table, query: pa.Table) -> pa.Table:
        found = {"query": [], "cls": [], "score": []}
        if base.num_rows and query.num_rows:
            base, query = base.sort_by("cls"), query.sort_by("cls")
            block = Block(base["cls"].to_numpy(), _matrix(base["embedding"]), top_norm)
            asked_ids = query["cls"].to_numpy()
            for cls, (at, scores) in zip(asked_ids, block.search(_matrix(query["embedding"]), k + 1), strict=True):
                found["query"].append(np.full(len(at), cls))
                found["cls"].append(block.ids[at])
                found["score"].append(scores)
        kinds = {"query": np.int64, "cls": np.int64, "score": np.float64}
        return pa.table({c: pa.array(np.concatenate(v) if v else np.empty(0, kinds[c])) for c, v in found.items()})

    base = dealt(classes, "b", n_base, "q", n_query).groupBy("b", "q")
    ask = dealt(asked, "q", n_query, "b", n_base).groupBy("b", "q")
    pairs = base.cogroup(ask).applyInArrow(search, "query long, cls long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "cls")
    top = pairs.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    members = top.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = members.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).select(F.col("query").alias("cls"), "vec_id", "score")
    answers = queries.join(short, "cls").filter("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all others."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
