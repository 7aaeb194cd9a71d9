"""Best-fit packing of token sequences under several capacities.

A piece has three sizes: its tokens, one document, and its attention cost (length
squared). A bin takes it only if all three residual capacities allow it; among those,
the piece goes where the weighted norm of the residual after placing is smallest
(``fit="norm"``) or where the weighted dot product with the residual is largest
(``fit="dot"``). Pieces are placed longest first.

Pieces are dealt by hash into blocks, and each block is packed alone, so no task holds
more than a block, and a block wastes about one bin at most.

Defined cases: a null or empty text is one piece of one token, the end. Repeated rows are
packed each on their own. A null id is kept. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import parts, stash, text_of

LENGTH = 2048
PIECES_PER_BLOCK = 8192
#: Weight of tokens, documents and attention cost; tokens decide, the others break ties.
WEIGHTS = (1.0, 1e-3, 1e-3)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_encoders: dict[str, object] = {}


def encoder(ranks_path: str | None = None):
    """The byte-level BPE by its rank file, once per process.

    It gives the ids that the ``tokenizers`` library gives for the same vocabulary (a test
    compares them), at about a quarter of the time.
    """
    import public_tokenizers
    import tiktoken

    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _encoders:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {"<|endoftext|>": len(ranks)}
        _encoders[path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
    return _encoders[path]


def encode(text: str, ranks_path: str | None = None) -> np.ndarray:
    return encoder(ranks_path).encode_to_numpy(text, allowed_special="all")


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first of several may be shorter."""
    first = n % length or length
    return [(0, min(n, first))] + [(s, length) for s in range(first, n, length)]


def token_pieces(docs: DataFrame, length: int = LENGTH, end_id: int = 0, ranks_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenize whole texts and cut the long ones; ``with_ids`` adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids_out = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text, ranks_path), end_id).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), length)):
                    piece = ids[start : start + n]
                    rows.append((doc_id, k, start, n, zlib.crc32(piece.tobytes())))
                    if with_ids:
                        ids_out.append(piece.astype(np.int32))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: tuple[float, float, float], weights=WEIGHTS, fit: str = "norm"):
    """Bin and offset of each piece."""
    cap = np.asarray(capacity, float)
    w = np.asarray(weights, float)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    residual = np.empty((0, 3))
    open_ids = np.empty(0, np.int64)
    used, n_open, n_bins = 0, 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        size = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        room = residual[:n_open] - size
        fits = np.flatnonzero((room >= 0).all(axis=1))
        if len(fits):
            if fit == "norm":
                at = fits[((room[fits] / cap) ** 2 @ w).argmin()]
            else:
                at = fits[(residual[fits] / cap**2 @ (w * size)).argmax()]
        else:
            if n_open == len(residual):  # closed bins go, then the table grows
                keep = residual[:n_open, 0] > 0
                residual, open_ids = residual[:n_open][keep], open_ids[:n_open][keep]
                n_open = len(residual)
                residual = np.concatenate([residual, np.empty((max(64, n_open), 3))])
                open_ids = np.concatenate([open_ids, np.empty(max(64, n_open), np.int64)])
            at, residual[n_open], open_ids[n_open] = n_open, cap, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[i], offsets[i] = open_ids[at], int(cap[0] - residual[at, 0])
        residual[at] -= size
        used += 1
    return bins, offsets


def pack_pieces(pieces: DataFrame, length: int = LENGTH, max_docs: int | None = None,
                max_attention: float | None = None, weights=WEIGHTS, fit: str = "norm") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with doc_id, piece and length.

    ``max_docs`` and ``max_attention`` default to what can never bind below ``length``
    tokens. A piece above ``max_attention`` alone gets a bin of its own.
    """
    capacity = (float(length), float(max_docs or length), float(max_attention or length**2))
    columns = pieces.columns
    pieces = stash(pieces, "pieces")
    n_blocks = parts(pieces.count(), PIECES_PER_BLOCK)
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        at = int(block["block"].iloc[0])
        block = block.drop(columns="block").sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, offsets = best_fit(block["length"].to_numpy(), capacity, weights, fit)
        return block.assign(sequence_id=(at << 32) + bins, offset=offsets)

    block = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_blocks))
    return pieces.withColumn("block", block).groupBy("block").applyInPandas(pack, schema).select(*columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, length: int = LENGTH, end_id: int = 0, **options) -> DataFrame:
    return pack_pieces(token_pieces(docs, length, end_id), length, **options)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 2048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
