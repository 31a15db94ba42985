"""Packing tokenized documents into sequences by vector best-fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.common import fresh, slices, whole_text
from loamframe.llm.wordbpe import WordBpe
from loamframe.session import scratch_path

SHARD_ROWS = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    documents: DataFrame, tokenizer: str, capacity: int = 2048, doc: str = "doc_id", text: str = "text", end_id: int = 0
) -> DataFrame:
    """Each document's ids followed by ``end_id``, cut into pieces of at most ``capacity``.

    One row per piece: its key, number, start (ids before it), length and the
    CRC-32 of its ids as little-endian unsigned 32-bit numbers. A null text is
    empty and gives one piece, the end mark. Keys may be null or repeated; each
    row is cut on its own. Other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.load(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        step = 4 * capacity
        for batch in slices(batches, 1):
            keys, out = batch.column(0).to_pylist(), []
            for key, said in zip(keys, batch.column(1)):
                ids = bpe.encode(said.as_py()) + end
                out += [
                    (key, n, n * capacity, len(part := ids[at : at + step]) // 4, zlib.crc32(part))
                    for n, at in enumerate(range(0, len(ids), step))
                ]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col(doc).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(cut, PIECES)


def fit_bins(lengths: np.ndarray, capacity: int, max_documents: int, max_cost: int, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item, longest items first.

    A bin has three residual capacities: tokens, documents and attention cost
    (the sum of squared lengths). Among the bins that can take an item under
    all three, ``rule`` "norm" takes the one whose weighted residual after
    placement has the least norm, "dot" the one whose residual has the largest
    weighted dot product with the item; ties go to the oldest bin.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    scale = np.array([1 / capacity, 1 / max_documents, 1 / max_cost]) * np.sqrt(np.array(weights))
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if n else 0
    left = np.zeros((3, 64), np.int64)  # residuals of the open bins
    number = np.zeros(64, np.int64)
    open_bins, made = 0, 0
    for item in order:
        size = int(lengths[item])
        need = np.array([size, 1, size * size])
        if open_bins:
            now = left[:, :open_bins]
            fits = np.flatnonzero((now[0] >= size) & (now[1] >= 1) & (now[2] >= need[2]))
        else:
            fits = ()
        if len(fits):
            seen = now[:, fits]
            if rule == "norm":
                after = (seen - need[:, None]) * scale[:, None]
                at = fits[int(np.argmin((after * after).sum(axis=0)))]
            else:
                at = fits[int(np.argmax(((need * scale * scale)[:, None] * seen).sum(axis=0)))]
        else:
            if open_bins == left.shape[1]:
                left, number = np.hstack([left, np.zeros_like(left)]), np.hstack([number, np.zeros_like(number)])
            at = open_bins
            left[:, at] = (capacity, max_documents, max_cost)
            number[at] = made
            open_bins, made = open_bins + 1, made + 1
        bins[item], offsets[item] = number[at], capacity - left[0, at]
        left[:, at] -= need
        if left[0, at] < shortest or left[1, at] < 1 or left[2, at] < shortest * shortest:
            # Nothing fits any more: the bin closes, later ones move up.
            left[:, at : open_bins - 1] = left[:, at + 1 : open_bins].copy()
            number[at : open_bins - 1] = number[at + 1 : open_bins].copy()
            open_bins -= 1
    return bins, offsets


def best_fit(
    pieces: DataFrame,
    capacity: int = 2048,
    max_documents: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length``.

    Rows are dealt at random over shards of about ``shard_rows`` rows, each of
    which is packed by one task; every shard leaves at most a few sequences
    unfilled, so the loss does not grow with the corpus. Without
    ``max_documents`` and ``max_cost`` these two never bind before the tokens
    do. A length of 1 to ``capacity`` is required (an error otherwise, as is a
    cost above ``max_cost`` of a single piece). Columns of those two names are
    replaced, all others kept. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    max_documents = max_documents or capacity
    max_cost = max_cost or capacity * capacity
    pieces = pieces.drop("sequence_id", "offset")
    row, shard = fresh(pieces, "_row"), fresh(pieces, "_shard")
    path = scratch_path(spark, "pieces")
    pieces.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    shards = max(1, -(-rows.count() // shard_rows))
    schema = rows.drop(row).schema.add("sequence_id", "long").add("offset", "long")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(row, ignore_index=True)  # the same order in every attempt
        lengths = group["length"].to_numpy(np.int64)
        if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity or lengths.max() ** 2 > max_cost):
            raise ValueError("a piece does not fit an empty sequence")
        bins, offsets = fit_bins(lengths, capacity, max_documents, max_cost, weights, rule)
        return group.drop(columns=[row, shard]).assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    return (
        rows.withColumn(shard, F.pmod(F.xxhash64(row), F.lit(shards)))
        .groupBy(shard)
        .applyInPandas(pack, schema)
    )
