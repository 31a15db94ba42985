"""Exact top-k by inner product over a pivot-distance index.

Vectors become integers, floor(1024 x) per component. With M the largest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) satisfy |q' - x'|^2 = |q|^2 + M^2 - 2 q.x,
so the largest inner products are the nearest neighbours and the triangle
inequality over a pivot p bounds a score: |q' - x'| >= | |q' - p| - |x' - p| |.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.session import scratch_path

PIVOTS = 24
RINGS = 8
BLOCK_ROWS = 2048
QUERY_ROWS = 512
EXACT = 2.0**53


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v, norm2): floor(scale * x) of each component x, as double.

    Left out: rows without a key, null or empty vectors, vectors with a null
    or non-finite component. Rows that share a key count as one, the least
    vector in array order.
    """
    parts = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.where(F.col(key).isNotNull() & (F.size(vector) > 0) & usable)
        .select(F.col(key).cast("long").alias("vec_id"), parts.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    )


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column, padded with zeros to one width."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of lifted rows to lifted pivots (the last column is the lift)."""
    lifted = np.hstack([x.astype(float), extra[:, None]])
    squares = (lifted**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * lifted @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:  # every partial sum is an integer that a double holds
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], object).astype(np.int64)


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, pivots: int = PIVOTS, rings: int = RINGS) -> DataFrame:
    """The k highest inner products of every query: query_id, rank, vec_id, score.

    ``vectors`` comes from ``integer_vectors``; ``is_query`` picks the queries.
    Candidates are all rows but the query's own; ties go to the smaller key; a
    query with fewer candidates returns them all. Shorter vectors are padded
    with zeros. Scores must fit 64 bits (an error otherwise). An empty table or
    no query gives no rows.

    Rows are keyed by nearest pivot, each pivot's rows are cut into annuli at
    quantiles of their distance, and an annulus of many rows (copies, a dense
    spot) is cut further into blocks, so no task holds an unbounded group.
    First each query meets the annulus that holds its own distance, which gives
    a k-th score to beat; then every other annulus that the triangle inequality
    does not rule out. Only the pivots (a fixed number of rows, taken by hash
    order) and the annuli's bounds (pivots x rings rows) are sent to all tasks.
    """
    spark = vectors.sparkSession
    raw = scratch_path(spark, "vectors")
    vectors.write.parquet(raw)
    rows = spark.read.parquet(raw)
    stats = rows.agg(F.max("norm2").alias("top"), F.max(F.size("v")).alias("width")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if stats["top"] is None:
        return empty
    top, width = float(stats["top"]), int(stats["width"])
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v", "norm2").collect()
    centres = np.zeros((len(chosen), width + 1))
    for row, c in zip(centres, chosen):
        row[: len(c["v"])] = c["v"]
        row[-1] = np.sqrt(max(0.0, top - c["norm2"]))
    slack = 1e-6 * (np.sqrt(top) + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), width)
            lift = np.sqrt(np.maximum(0.0, top - b.column(2).to_numpy()))
            d = _distances(x, lift, centres)
            near = d.argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(near), pa.array(d[np.arange(len(d)), near])], names=["vec_id", "v", "pivot", "dist"]
            )

    indexed = scratch_path(spark, "annuli")
    placed = scratch_path(spark, "placed")
    rows.select("vec_id", "v", "norm2").mapInArrow(place, "vec_id long, v array<long>, pivot int, dist double").write.parquet(placed)
    near = spark.read.parquet(placed)
    cuts = near.groupBy("pivot").agg(F.percentile_approx("dist", [i / rings for i in range(1, rings)], 1000).alias("cuts"))
    # At most ``pivots`` rows.
    limits = {r["pivot"]: sorted(set(r["cuts"])) for r in cuts.collect()}
    at = F.create_map(*[F.lit(x) for p, c in limits.items() for x in (p, c)])
    ring = F.size(F.filter(at[F.col("pivot")], lambda c: c < F.col("dist")))
    near.withColumn("ring", ring).write.parquet(indexed)
    index = spark.read.parquet(indexed)
    bounds = index.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()
    cells = [(r["pivot"], r["ring"], r["n"], r["low"], r["high"]) for r in bounds]
    cell_pivot = np.array([c[0] for c in cells])
    cell_low, cell_high = np.array([c[3] for c in cells]), np.array([c[4] for c in cells])
    cell_rows = [(c[0], c[1], n, -(-c[2] // BLOCK_ROWS)) for n, c in enumerate(cells)]
    # pivots x rings rows at most, whatever the size of the table
    numbered = F.broadcast(spark.createDataFrame(cell_rows, "pivot int, ring int, cell int, blocks long"))
    candidates = (
        index.join(numbered, ["pivot", "ring"])
        .select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"))
        .groupBy("cell", "block")
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    )
    asked = rows.where(is_query).select("vec_id", "v", "norm2")

    def visits(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column(1), width)
                # A query is lifted with 0: its distances are those to q'.
                d = _distances(x, np.zeros(len(x)), centres)
                gap = np.maximum(0, np.maximum(cell_low - d[:, cell_pivot], d[:, cell_pivot] - cell_high) - slack)
                best = (b.column(2).to_numpy()[:, None] + top - gap**2) / 2 + slack  # no score in the cell is higher
                first = best.argmax(1)
                if home:
                    who, cell = np.arange(len(x)), first
                else:
                    floor = b.column(3).to_numpy(zero_copy_only=False).astype(float)
                    open_cells = best >= np.where(np.isnan(floor), -np.inf, floor)[:, None]
                    open_cells[np.arange(len(x)), first] = False
                    who, cell = np.nonzero(open_cells)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(who)), b.column(1).take(pa.array(who)), pa.array(cell.astype(np.int32))], names=["query_id", "q", "cell"]
                )

        return run

    def meet(visiting: DataFrame) -> DataFrame:
        """Best k of each (query, candidate block), in blocks of queries."""
        asking = visiting.groupBy("cell", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).alias("part")).agg(
            F.collect_list(F.struct("query_id", "q")).alias("queries")
        )

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for n in range(b.num_rows):
                    mine, theirs = b.column(0)[n].values, b.column(1)[n].values
                    ids, keys = mine.field(0).to_numpy(), theirs.field(0).to_numpy()
                    score = _products(_matrix(mine.field(1), width), _matrix(theirs.field(1), width))
                    out = []
                    for i, own in enumerate(ids):
                        s = score[i]
                        take = np.flatnonzero(keys != own)
                        if len(take) > k:
                            least = np.partition(s[take], len(take) - k)[len(take) - k]
                            take = take[s[take] >= least]
                        take = take[np.lexsort((keys[take], -s[take]))[:k]]
                        out.append((np.full(len(take), own), keys[take], s[take]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

        return asking.join(candidates, "cell").select("queries", "rows").mapInArrow(best, "query_id long, vec_id long, score long")

    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    first_path = scratch_path(spark, "first")
    meet(asked.mapInArrow(visits(True), "query_id long, q array<long>, cell int")).withColumn("rank", rank).where(F.col("rank") <= k).drop("rank").write.parquet(first_path)
    first = spark.read.parquet(first_path)
    floor = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
    bounded = asked.join(floor, asked["vec_id"] == floor["query_id"], "left").select("vec_id", "v", "norm2", F.col("s").alias("floor"))
    rest = meet(bounded.mapInArrow(visits(False), "query_id long, q array<long>, cell int"))
    return (
        first.unionByName(rest)
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
