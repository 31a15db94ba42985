"""Hard negatives by integer inner product over an R-tree of packed boxes.

Rows are dealt by sort-tile-recursive slicing: a bounded number of tiles, each in
blocks of bounded size, and in every block leaves of a few rows with their
minimum bounding boxes, packed the same way. Between an anchor q and a box the
inner product lies between the sums over coordinates of the lesser and of the
greater of q*low and q*high; these intervals decide which boxes are opened.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.llm.common import shuffles_removed
from loamframe.session import scratch_path

SAMPLE = 8192  # rows that decide where tiles are cut
MAX_TILES = 1024
BLOCK_ROWS = 1024
LEAF_ROWS = 32
FAN = 8
AT_ONCE = 8  # leaves opened together
QUERY_ROWS = 256
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1
WINDOWS = "array<struct<id:long,low:long,high:long,floor:long>>"


def labelled_vectors(df: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component x, as double.

    Left out: rows without a key or a label, null or empty vectors, vectors with
    a null or non-finite component. Rows that share a key count as one, the
    least by label, then by vector.
    """
    parts = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.where(F.col(key).isNotNull() & label.isNotNull() & (F.size(vector) > 0) & usable)
        .select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), parts.alias("v"))
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "v")).alias("s"))
        .select("vec_id", "s.label", "s.v")
    )


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as integers, padded with zeros to one width."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as bytes of the least width that holds them all."""
    kind = next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(k).max)
    return x.astype(f"<{kind}").tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (rows * width)}").astype(np.int64).reshape(rows, width)


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of x with q; an error beyond 64 bits."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q) < EXACT:
        return (x.astype(float) @ q.astype(float)).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q)) for row in x], np.int64)


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each row of q with each box.

    Widened where the numbers are too large for a double to be exact.
    """
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    least, most = up @ low.T.astype(float) + down @ high.T.astype(float), up @ high.T.astype(float) + down @ low.T.astype(float)
    top = float(np.abs(q).max(initial=0)) * float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))) * q.shape[1]
    slack = 0.0 if top < EXACT else top * q.shape[1] * 2.0**-50
    return least - slack, most + slack


def packed_order(x: np.ndarray, leaf: int = LEAF_ROWS, coordinates: int = 3) -> np.ndarray:
    """Sort-tile-recursive order of rows: consecutive runs of ``leaf`` rows are
    the leaves. The coordinates that spread most are sliced, one after another."""
    chosen = np.argsort(-x.var(axis=0), kind="stable")[:coordinates]

    def tile(rows: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
        rows = rows[np.argsort(x[rows, left[0]], kind="stable")]
        leaves = -(-len(rows) // leaf)
        if len(left) == 1 or leaves == 1:
            return [rows]
        slices = max(2, int(np.ceil(leaves ** (1 / len(left)))))
        size = leaf * -(-leaves // slices)
        return [part for at in range(0, len(rows), size) for part in tile(rows[at : at + size], left[1:])]

    return np.concatenate(tile(np.arange(len(x)), chosen)) if len(x) else np.arange(0)


@dataclass
class Tree:
    """Boxes of a block, level by level from the leaves to one root."""

    x: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: list[int]  # number of the first box of each level
    sizes: list[int]

    @classmethod
    def of(cls, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
        """The tree over rows that already lie in packed order."""
        runs = lambda n, size: np.arange(0, n, size)
        at = runs(len(x), LEAF_ROWS)
        lows, highs = [np.minimum.reduceat(x, at)], [np.maximum.reduceat(x, at)]
        while len(lows[-1]) > 1:
            at = runs(len(lows[-1]), FAN)
            lows.append(np.minimum.reduceat(lows[-1], at))
            highs.append(np.maximum.reduceat(highs[-1], at))
        sizes = [len(level) for level in lows]
        return cls(x, ids, labels, np.vstack(lows), np.vstack(highs), np.cumsum([0] + sizes[:-1]).tolist(), sizes)


class Best:
    """The k best rows of one window of scores seen so far."""

    def __init__(self, low: int, high: int, floor: int | None, k: int):
        self.low, self.high, self.k = low, high, k
        self.bound = max(low, LEAST if floor is None else floor)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        take = (scores >= self.bound) & (scores <= self.high)
        if not take.any():
            return
        scores, ids = np.concatenate([self.scores, scores[take]]), np.concatenate([self.ids, ids[take]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.bound = max(self.bound, int(self.scores[-1]))


def search(tree: Tree, q: np.ndarray, least: np.ndarray, most: np.ndarray, allowed: np.ndarray, windows: list[Best]) -> int:
    """Best-first search: boxes wait in a queue by their greatest possible score.

    A box is left out when it lies outside every window's scores or strictly
    below every window's k-th best; the search ends when the first in the queue
    is. Returns the number of leaves opened.
    """
    wanted = lambda box: any(most[box] >= w.bound and least[box] <= w.high for w in windows)
    root = len(most) - 1
    queue = [(-most[root], root, len(tree.sizes) - 1)] if wanted(root) else []
    opened = 0
    while queue:
        rows: list[np.ndarray] = []
        while queue and len(rows) < AT_ONCE:
            _, box, level = heapq.heappop(queue)
            if not wanted(box):
                continue
            place = box - tree.first[level]
            if level == 0:
                rows.append(np.arange(place * LEAF_ROWS, min((place + 1) * LEAF_ROWS, len(tree.x))))
                continue
            below = tree.first[level - 1]
            for child in range(below + place * FAN, below + min((place + 1) * FAN, tree.sizes[level - 1])):
                if wanted(child):
                    heapq.heappush(queue, (-most[child], child, level - 1))
        if rows:
            opened += len(rows)
            at = np.concatenate(rows)
            at = at[allowed[at]]
            scores = products(tree.x[at], q)
            for w in windows:
                w.add(scores, tree.ids[at])
    return opened


@dataclass
class Forest:
    """``rows``: (vec_id, label, v); ``blocks``: (tile, ids, labels, v) rows in packed
    order, v as ``packed`` bytes; boxes of the tiles."""

    rows: DataFrame
    blocks: DataFrame
    width: int
    tiles: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _cuts(sample: np.ndarray, tiles: int) -> tuple[np.ndarray, list[np.ndarray], int]:
    """Sort-tile-recursive slicing of a sample: the coordinates in turn, where
    each tile of a level is cut along the next one, and the slices per level."""
    levels = max(1, int(np.ceil(np.log(max(tiles, 1)) / np.log(4) - 1e-9)))
    levels = min(levels, sample.shape[1])
    slices = max(1, int(np.ceil(tiles ** (1 / levels) - 1e-9)))
    chosen = np.argsort(-sample.var(axis=0), kind="stable")[:levels]
    cuts, parts = [], [np.arange(len(sample))]
    for c in chosen:
        here, inner = np.zeros((len(parts), slices - 1), np.int64), []
        for n, rows in enumerate(parts):
            rows = rows[np.argsort(sample[rows, c], kind="stable")]
            if len(rows):
                here[n] = [sample[rows[len(rows) * i // slices], c] for i in range(1, slices)]
            side = (here[n] < sample[rows, c][:, None]).sum(1)
            inner += [rows[side == i] for i in range(slices)]
        cuts.append(here)
        parts = inner
    return chosen, cuts, slices


def _sampled(rows: DataFrame, n: int) -> DataFrame:
    """The first SAMPLE of ``n`` rows by hash order. Every task sends the driver the
    first ones it has, so only hashes below a bound that a quarter more pass take part."""
    order = F.xxhash64("vec_id")
    if n > 2 * SAMPLE:
        rows = rows.where(order < F.lit(LEAST + 2**64 * (SAMPLE + SAMPLE // 4) // n))
    return rows.orderBy(order, "vec_id").limit(SAMPLE).select("v")


def build_forest(vectors: DataFrame) -> Forest | None:
    """Index of all rows of (vec_id, label, v); None without rows.

    Tiles are cut on a bounded sample (SAMPLE rows by hash order), but every row
    is placed and every box holds all its rows. A tile with many rows (copies of
    one vector, a dense spot, a large table) is cut by hash into blocks of about
    BLOCK_ROWS rows, so no task holds an unbounded group. What the driver and
    every task hold is bounded by MAX_TILES.
    """
    spark = vectors.sparkSession
    raw = scratch_path(spark, "vectors")
    with shuffles_removed(spark):
        vectors.write.parquet(raw)
    rows = spark.read.parquet(raw)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    if not stats["n"]:
        return None
    width, wanted = int(stats["width"]), min(MAX_TILES, -(-stats["n"] // BLOCK_ROWS))
    found = _sampled(rows, stats["n"]).collect()
    sample = np.zeros((len(found), width), np.int64)
    for to, r in zip(sample, found):
        to[: len(r["v"])] = r["v"]
    coordinates, cuts, slices = _cuts(sample, wanted)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(2), width)
            tile = np.zeros(len(x), np.int64)
            for c, here in zip(coordinates, cuts):
                tile = tile * slices + (here[tile] < x[:, c][:, None]).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tile)], names=["vec_id", "label", "v", "tile"])

    placed_path = scratch_path(spark, "placed")
    rows.select("vec_id", "label", "v").mapInArrow(place, "vec_id long, label long, v array<long>, tile long").write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)
    sizes = {r["tile"]: -(-r["count"] // BLOCK_ROWS) for r in placed.groupBy("tile").count().collect()}
    blocks = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("tile")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                group = b.column(1)[n].values
                group = group.take(pa.compute.sort_indices(group.field(0)))
                x = matrix(group.field(2), width)
                order = packed_order(x)
                values = [group.field(0).to_numpy()[order], group.field(1).to_numpy()[order], x.min(axis=0), x.max(axis=0)]
                ids, labels, low, high = (pa.array([v], pa.list_(pa.int64())) for v in values)
                v = pa.array([packed(x[order])], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(n, 1), ids, labels, v, low, high], names=["tile", "ids", "labels", "v", "low", "high"])

    index_path = scratch_path(spark, "boxes")
    grouped = placed.groupBy("tile", F.pmod(F.xxhash64("vec_id"), blocks).alias("block")).agg(F.collect_list(F.struct("vec_id", "label", "v")).alias("rows"))
    with shuffles_removed(spark):
        grouped.select("tile", "rows").mapInArrow(
            pack, "tile long, ids array<long>, labels array<long>, v binary, low array<long>, high array<long>"
        ).write.parquet(index_path)
    index = spark.read.parquet(index_path)
    side = lambda name, merge: [merge(F.col(name)[i]).alias(f"{name}{i}") for i in range(width)]
    boxes = index.groupBy("tile").agg(*side("low", F.min), *side("high", F.max)).orderBy("tile").collect()
    table = np.array([list(r) for r in boxes], np.int64)
    return Forest(placed, index.select("tile", "ids", "labels", "v"), width, table[:, 0], table[:, 1 : width + 1], table[:, width + 1 :])


def nearest(forest: Forest, asked: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The k best rows of every window: anchor_id, window (its id), vec_id, score.

    ``asked`` has anchor_id, label, q and ``windows`` (WINDOWS; ids differ within
    an anchor), whose scores run from low to high. Higher scores come first, ties by smaller key; rows have the
    anchor's label or, without ``same_label``, another one; never the anchor.

    Each anchor first meets the tile with the greatest possible score, which
    gives every window a k-th score (``floor``); then all other tiles that reach
    into a window at or above it.
    """
    spark = asked.sparkSession
    width, tiles, lows, highs = forest.width, forest.tiles, forest.low, forest.high  # at most MAX_TILES rows
    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    columns = ["anchor_id", "label", "q", "windows"]

    def route(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                least, most = intervals(matrix(b.column(2), width), lows, highs)
                first = most.argmax(1)
                open_tiles = np.zeros(most.shape, bool)
                for n, windows in enumerate(b.column(3).to_pylist()):
                    if home:
                        open_tiles[n, first[n]] = True
                        continue
                    for w in windows:
                        low = w["low"] if w["floor"] is None else max(w["low"], w["floor"])
                        open_tiles[n] |= (most[n] >= low) & (least[n] <= w["high"])
                    open_tiles[n, first[n]] = False
                who, tile = np.nonzero(open_tiles)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(who)) for c in b.columns), pa.array(tiles[tile])], names=[*columns, "tile"])

        return run

    def meet(home: bool, questions: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("anchor_id"), F.lit(query_blocks))
        visits = questions.select(*columns).mapInArrow(route(home), f"anchor_id long, label long, q array<long>, windows {WINDOWS}, tile long")
        asking = visits.groupBy("tile", part.alias("part")).agg(F.collect_list(F.struct(*columns)).alias("anchors"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for n in range(b.num_rows):
                    anchors = b.column(0)[n].values
                    ids, labels = (b.column(i)[n].values.to_numpy() for i in (1, 2))
                    tree = Tree.of(unpacked(b.column(3)[n].as_py(), len(ids), width), ids, labels)
                    q = matrix(anchors.field(2), width)
                    least, most = intervals(q, tree.low, tree.high)
                    out = []
                    own, kinds = anchors.field(0).to_numpy(), anchors.field(1).to_numpy()
                    for i, said in enumerate(anchors.field(3).to_pylist()):
                        windows = [Best(w["low"], w["high"], w["floor"], k) for w in said]
                        allowed = ((tree.labels == kinds[i]) == same_label) & (tree.ids != own[i])
                        search(tree, q[i], least[i], most[i], allowed, windows)
                        out += [(np.full(len(w.ids), own[i]), np.full(len(w.ids), g["id"]), w.ids, w.scores) for g, w in zip(said, windows)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["anchor_id", "window", "vec_id", "score"]
                    )

        # Sorted, never broadcast: blocks and anchors are many times their files' size, and the
        # driver would hold them. The side that waits for a tile's blocks is the anchors'.
        met = forest.blocks.join(asking.hint("merge"), "tile").select("anchors", "ids", "labels", "v")
        return met.mapInArrow(run, "anchor_id long, window long, vec_id long, score long")

    def ranked(df: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
        return df.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")

    path = scratch_path(spark, "first")
    with shuffles_removed(spark):
        ranked(meet(True, asked)).write.parquet(path)
    first = spark.read.parquet(path)
    kth = first.groupBy("anchor_id", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    floors = kth.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("floors"))  # a row per window
    known = F.transform("windows", lambda w: F.struct(w["id"], w["low"], w["high"], F.try_element_at("floors", w["id"]).alias("floor")))
    rest = meet(False, asked.join(floors.hint("merge"), "anchor_id", "left").withColumn("windows", known))
    return ranked(first.unionByName(rest))


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, most_percent: int = 100
) -> DataFrame:
    """Rows of another label whose score comes close to a positive's.

    ``vectors`` comes from ``labelled_vectors``; ``is_anchor`` picks the anchors.
    An anchor's positives are its first ``positives`` other rows of the same
    label by score; a negative of one has another label and a score s with
    least_percent * p <= 100 * s <= most_percent * p, p being the positive's
    score (a negative p has none). All positives and all windows are met in
    full; fewer rows than asked for are returned as they are; a positive without
    any gives no row. Shorter vectors are padded with zeros. No rows or no
    anchor: no rows.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    forest = build_forest(vectors)
    if forest is None:
        return spark.createDataFrame([], schema)
    anchors_path = scratch_path(spark, "anchors")
    rows = forest.rows.select("vec_id", "label", F.col("v").alias("q"))
    rows.where(is_anchor).withColumnRenamed("vec_id", "anchor_id").write.parquet(anchors_path)
    anchors = spark.read.parquet(anchors_path)
    none = F.lit(None).cast("long")
    window = lambda i, low, high: F.struct(i.alias("id"), low.alias("low"), high.alias("high"), none.alias("floor"))
    anything = F.array(window(F.lit(0).cast("long"), F.lit(LEAST), F.lit(MOST)))
    positives_path = scratch_path(spark, "positives")
    first = nearest(forest, anchors.withColumn("windows", anything), True, positives)
    with shuffles_removed(spark):
        first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(positives_path)
    found = spark.read.parquet(positives_path)
    # ceil and floor of whole numbers, beyond 64 bits where need be
    score = F.col("positive_score").cast("decimal(38,0)")
    low = F.ceil(score * least_percent / 100).cast("long")
    high = F.floor(score * most_percent / 100).cast("long")
    bounded = found.withColumns({"low": low, "high": high})
    asked = bounded.where("low <= high").groupBy("anchor_id").agg(F.collect_set(window(F.col("positive_score"), F.col("low"), F.col("high"))).alias("windows"))
    met = nearest(forest, anchors.join(asked.hint("merge"), "anchor_id"), False, negatives)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
    return bounded.where("low <= high").join(met.withColumnRenamed("window", "positive_score").hint("merge"), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", rank.cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
