"""Token files: ids of documents in key order, compressed by a Re-Pair grammar.

A file is Parquet, one per range of keys (a shard), and each of its rows is a
block of whole documents: their keys and numbers of ids, the grammar's rules,
how many ids each rule stands for, and the block's symbols. A symbol below
``base`` is an id, ``base + r`` stands for the two symbols of rule ``r``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamframe.llm.bytebpe import ByteBpe
from loamframe.llm.common import tasks, whole_text
from loamframe.session import scratch_path

BLOCK_IDS = 1 << 20
LEAST = 8  # a pair must occur this often to become a rule
PER_ROUND = 20_000  # pairs replaced at once, most frequent first

BLOCKS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("keys", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("base", pa.int64()), ("width", pa.int32()), ("rules", pa.binary()), ("spans", pa.binary()), ("symbols", pa.binary()),
    ]
)
_BLOCKS_DDL = "shard int, block int, first long, n_ids long, keys array<long>, counts array<long>, base long, width int, rules binary, spans binary, symbols binary"


def _chosen(pairs: np.ndarray, shift: int, room: int) -> np.ndarray:
    """The first pairs that may be replaced together: no symbol is both the
    left of one and the right of another, so no two occurrences overlap."""
    left, right, out = set(), set(), []
    mask = (1 << shift) - 1
    for pair in pairs.tolist():
        a, b = pair >> shift, pair & mask
        if a in right or b in left or (a == b and (a in left or b in right)):
            continue
        left.add(a)
        right.add(b)
        out.append(pair)
        if len(out) == room:
            break
    return np.sort(np.array(out, pairs.dtype))


def build_grammar(ids: np.ndarray, base: int, width: int, least: int = LEAST, per_round: int = PER_ROUND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules as pairs, ids per rule) of a block.

    Round by round the most frequent pairs of neighbours, up to ``per_round``
    that cannot overlap, become rules; it ends when no pair occurs ``least``
    times or symbols of ``width`` bytes run out. Of a run of one symbol every
    two are a pair, from its start.
    """
    kind, shift = (np.uint32, 16) if width == 2 else (np.uint64, 32)
    seq, rules, spans = ids.astype(kind), np.empty((0, 2), np.uint32), np.empty(0, np.int64)
    while len(seq) > 1 and (room := (1 << shift) - base - len(rules)) > 0:
        keys = (seq[:-1] << kind(shift)) | seq[1:]
        ordered = np.sort(keys)
        starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        best = np.argsort(-counts[often], kind="stable")[:per_round]
        pairs = _chosen(ordered[starts[often[best]]], shift, room)
        symbols = np.column_stack([pairs >> kind(shift), pairs & kind((1 << shift) - 1)]).astype(np.uint32)
        top = base + len(rules)
        is_left, is_right = np.zeros(top, bool), np.zeros(top, bool)
        is_left[symbols[:, 0]], is_right[symbols[:, 1]] = True, True
        at = np.flatnonzero(is_left[seq[:-1]] & is_right[seq[1:]])
        rule = np.searchsorted(pairs, keys[at])
        rule[rule == len(pairs)] = 0
        real = pairs[rule] == keys[at]
        at, rule = at[real], rule[real]
        # Neighbouring places lie in a run of one symbol: every second one counts.
        place = np.arange(len(at))
        start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, place, 0))
        even = (place - start) % 2 == 0
        at, rule = at[even], rule[even]
        seq[at] = (top + rule).astype(kind)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        size = np.concatenate([np.ones(base, np.int64), spans])
        rules, spans = np.vstack([rules, symbols]), np.concatenate([spans, size[symbols[:, 0]] + size[symbols[:, 1]]])
    return seq.astype(np.uint16 if width == 2 else np.uint32), rules, spans


def expansions(rules: np.ndarray, spans: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all rules one after the other, where each rule's start)."""
    starts = np.cumsum(spans) - spans
    out = np.empty(int(spans.sum()), np.int64)
    for at, n, (a, b) in zip(starts.tolist(), spans.tolist(), rules.tolist()):
        middle = at + (1 if a < base else int(spans[a - base]))
        if a < base:
            out[at] = a
        else:  # an earlier rule
            from_ = starts[a - base]
            out[at:middle] = out[from_ : from_ + middle - at]
        if b < base:
            out[middle] = b
        else:
            from_ = starts[b - base]
            out[middle : at + n] = out[from_ : from_ + at + n - middle]
    return out, starts


class Block:
    """A block's grammar, read back."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.symbols = np.frombuffer(row["symbols"], "<u2" if row["width"] == 2 else "<u4").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
        self.spans = np.frombuffer(row["spans"], "<u4").astype(np.int64)
        self.said, self.starts = expansions(self.rules, self.spans, self.base)
        self.ends: np.ndarray | None = None

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        rule = symbols - self.base
        inner = rule >= 0
        size = np.ones(len(symbols), np.int64)
        size[inner] = self.spans[rule[inner]]
        ends = np.cumsum(size)
        out = np.empty(int(ends[-1]) if len(ends) else 0, "<u4")
        out[ends[~inner] - 1] = symbols[~inner]
        size, starts, to = size[inner], self.starts[rule[inner]], (ends - size)[inner]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(to, size) + step] = self.said[np.repeat(starts, size) + step]
        return out

    def all_ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on, without decoding the others.

        The expansion lengths say which symbols hold them; only the first and
        the last of these can hold others as well.
        """
        if n <= 0:
            return np.empty(0, "<u4")
        if self.ends is None:
            size = np.concatenate([np.ones(self.base, np.int64), self.spans])
            self.ends = np.cumsum(size[self.symbols])
        low, high = np.searchsorted(self.ends, [start, start + n - 1], side="right")
        before = self.ends[low - 1] if low else 0
        return self.expand(self.symbols[low : high + 1])[start - before : start - before + n]


def token_rows(documents: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row, ids): the ids of each text and ``end_id``, 2 or 4 bytes an id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.load(tokenizer)
        kind = "<u2" if max(bpe.size, end_id + 1) <= 1 << 16 else "<u4"
        for b in batches:
            ids = bpe.encode_texts(b.column(2).to_pylist(), end_id, kind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids], names=["key", "row", "ids"])

    rows = documents.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("row"), whole_text(text).alias("text"))
    return rows.mapInArrow(encode, "key long, row long, ids binary")


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int, path: str, block_ids: int = BLOCK_IDS, **columns: str) -> None:
    """Writes the ids of all documents in ascending key order to token files.

    Each text's ids (library rules, no special tokens) are followed by
    ``end_id``; a null text is empty. Null keys come first, rows of one key in
    the order they are read. Other columns are ignored; an empty table gives
    files without blocks. Texts become ids before they are dealt to shards; the
    row number breaks ties, so a repeated key is split over shards like any
    other. A block closes at ``block_ids`` ids and always holds whole documents.
    """
    spark = documents.sparkSession
    unordered = scratch_path(spark, "ids")
    token_rows(documents, tokenizer, end_id, **columns).write.parquet(unordered)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(ByteBpe.load(tokenizer).size, end_id + 1)
        stored = 2 if size <= 1 << 16 else 4
        width = 2 if (1 << 16) - size >= 4096 else 4  # room for rules
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        keys, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            counts = [len(p) // stored for p in parts]
            ids = np.frombuffer(b"".join(parts), f"<u{stored}")
            symbols, rules, spans = build_grammar(ids, size, width)
            row = [shard, number, first, held, keys, counts, size, width, rules.astype("<u4").tobytes(), spans.astype("<u4").tobytes(), symbols.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)

        for b in batches:
            for key, ids in zip(b.column(0).to_pylist(), b.column(1)):
                keys.append(key)
                parts.append(ids.as_py())
                held += len(parts[-1]) // stored
                if held >= block_ids:
                    yield block()
                    number, first, keys, parts, held = number + 1, first + held, [], [], 0
        if keys:
            yield block()

    order = [F.asc_nulls_first("key"), F.asc("row")]
    dealt = spark.read.parquet(unordered).repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    dealt.select("key", "ids").mapInArrow(compress, _BLOCKS_DDL).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, keys: DataFrame | None = None, checksum: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids) of every document of token files, or of some.

    ``start`` counts the ids of all documents before it; ``ids`` are unsigned
    32-bit, little-endian, with ``checksum`` their CRC-32 instead. With ``keys`` (a DataFrame with a column ``key``; null
    never matches) only the blocks and the stretches that hold those documents
    are decoded. Only one number per shard is sent to all tasks.
    """
    blocks = spark.read.parquet(path)
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", before.alias("before"))
    placed = blocks.join(F.broadcast(shards), "shard").withColumn("before", F.col("before") + F.col("first"))
    columns = ["before", "keys", "counts", "base", "width", "rules", "spans", "symbols"]
    if keys is None:
        placed = placed.select(*columns, F.lit(None).cast("array<int>").alias("wanted"))
    else:
        named = blocks.select("shard", "block", F.posexplode("keys").alias("at", "key")).join(keys.select("key").distinct(), "key", "left_semi")
        wanted = named.groupBy("shard", "block").agg(F.array_sort(F.collect_list("at")).alias("wanted"))  # at most a block's documents
        placed = placed.join(wanted, ["shard", "block"]).select(*columns, "wanted")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                row = {f.name: b.column(i)[n].as_py() for i, f in enumerate(b.schema)}
                block, counts = Block(row), np.array(row["counts"], np.int64)
                starts = np.cumsum(counts) - counts
                if row["wanted"] is None:
                    wanted, ids = np.arange(len(counts)), block.all_ids()
                    found = [ids[s : s + c] for s, c in zip(starts.tolist(), counts.tolist())]
                else:
                    wanted = np.array(row["wanted"], np.int64)
                    found = [block.ids(int(starts[i]), int(counts[i])) for i in wanted]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["keys"][i] for i in wanted], pa.int64()), pa.array(row["before"] + starts[wanted]), pa.array(counts[wanted]),
                        pa.array([zlib.crc32(i) for i in found], pa.int64()) if checksum else pa.array([i.tobytes() for i in found], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(decode, "key long, start long, n_tokens long, ids " + ("long" if checksum else "binary"))
