"""Language-model scoring with a probabilistic suffix tree over words.

A text is a run of tokens: its lower-cased words, then one end. The root of the
tree predicts a token from its count alone; a longer context (the one or two
tokens before, where a text's start counts as a token) becomes a state only if
its next-token counts diverge enough from what its suffix predicts. A token is
scored in the longest suffix of its history that is a state.

The tree is never gathered in one place. Texts become batches of codes; each
batch sends its distinct contexts and next tokens to shards, which add up the
counts of all batches, test the contexts they own and answer each batch.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.llm.common import shuffles_removed, tasks, whole_text
from loamframe.session import scratch_path

LEAST = 4  # occurrences a context needs to be tested
GAIN = 0.0  # nats a context must gain over its suffix on its own occurrences, each predicted from the others
DISCOUNT = 0.75  # taken off each next token's count in a state, for the suffix's distribution
PRIOR = 20.0  # weight of the suffix's distribution besides that
COMMON = 64  # a context with 1/COMMON of all tokens is common: its next tokens are dealt over all shards
BATCH_CHARS = 12_000_000
END = b"\t"  # white space, so never a word


def _press(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=12).compress(b)


def _expand(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def _pack(a: np.ndarray) -> bytes:
    """Compressed bytes; like bytes of the numbers side by side."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T if a.size else a.view(np.uint8)
    return _press(np.ascontiguousarray(planes).tobytes())


def _unpack(b: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(_expand(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


# -- texts to batches ---------------------------------------------------------

BATCH = pa.schema([
    ("batch", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("seen", pa.binary()), ("ids", pa.list_(pa.int64())),
    ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("codes", pa.binary()), ("shards", pa.binary()),
])
BATCH_SQL = "batch long, shard int, words binary, seen binary, ids array<long>, held array<boolean>, sizes array<int>, codes binary, shards binary"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    part, chars = [], 0
    for b in batches:
        for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            part.append(row)
            chars += len(row[1])
            if chars >= BATCH_CHARS:
                yield part
                part, chars = [], 0
    if part:
        yield part


def _batches(texts: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A row of codes per batch (shard -1), and a row per shard with the batch's
    distinct words there and how often its training texts have them."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for part in _parts(texts):
        codes_of: dict[bytes, int] = defaultdict(count().__next__)
        codes = []
        for _, text, _ in part:
            words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
            words.append(END)
            codes.append(np.fromiter(map(codes_of.__getitem__, words), np.int32, len(words)))
        sizes, flat, words = [len(c) for c in codes], np.concatenate(codes), list(codes_of)
        held = [row[2] for row in part]
        seen = np.bincount(flat[np.repeat(~np.array(held, bool), sizes)], minlength=len(words)).astype(np.int32)
        shard = np.fromiter((zlib.crc32(w) % shards for w in words), np.int32, len(words))
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = [(number, -1, None, None, [row[0] for row in part], held, sizes, _pack(flat), _pack(shard))]
        for s in np.flatnonzero(np.diff(ends)):
            mine = order[ends[s] : ends[s + 1]]
            rows.append((number, int(s), _press(b"\n".join([words[i] for i in mine])), _pack(seen[mine]), *[None] * 5))
        number += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BATCH)], schema=BATCH)


# -- shards -------------------------------------------------------------------

ANSWER_SQL = "batch long, step int, shard int, word binary, counts binary, flags binary, stats array<long>"
ANSWER = ["batch", "step", "shard", "word", "counts", "flags", "stats"]


def _count_words(shards: int):
    """Numbers a shard's words and tells each batch their numbers and counts."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        at: dict[bytes, int] = defaultdict(count().__next__)
        rows = []
        for blob in group["words"]:
            words = _expand(blob).split(b"\n")
            rows.append(np.fromiter(map(at.__getitem__, words), np.int64, len(words)))
        total = np.zeros(len(at), np.int64)
        for index, seen in zip(rows, group["seen"]):
            total[index] += _unpack(seen, np.int32)  # the words of a row are distinct
        stats = [int(total.sum()), int((total > 0).sum())]
        out = [
            (b, 1, s, _pack(index * shards + s), _pack(total[index]), None, stats if n == 0 else None)
            for n, (b, s, index) in enumerate(zip(group["batch"], group["shard"], rows))
        ]
        return pd.DataFrame(out, columns=ANSWER)

    return run


def _test_contexts(step: int, tokens: int, shards: int):
    """Adds up next-token counts of a shard's contexts, tests each context, and
    tells each batch the counts and which of its contexts are states."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = [
            (np.cumsum(_unpack(r.context, np.int64)), _unpack(r.times, np.int64), runs := _unpack(r.runs, np.int32), _summed(_unpack(r.next, np.int64), runs), _unpack(r.n, np.int32), _unpack(r.bits, np.uint8))
            for r in group.itertuples()
        ]
        context = np.concatenate([np.repeat(r[0], r[2]) for r in rows])
        times = np.concatenate([np.repeat(r[1], r[2]) for r in rows])
        follow, n, bits = (np.concatenate([r[i] for r in rows]) for i in (3, 4, 5))
        order = _order(np.zeros(len(context), np.int64), context, follow)
        c, f = context[order], follow[order]
        new_context = np.append(True, c[1:] != c[:-1])
        new_pair = new_context | np.append(True, f[1:] != f[:-1])
        first = np.flatnonzero(new_pair)
        sums = np.add.reduceat(n[order].astype(np.int64), first)
        all_times = times[order][first].astype(float)
        of_context = np.cumsum(new_context)[first] - 1
        # All that follows a context is here, but for the common ones, which say how often they occur.
        told = all_times[np.flatnonzero(new_context[first])]
        total = np.where(told > 0, told, np.bincount(of_context, sums))
        kinds = np.bincount(of_context, sums > 0)  # distinct next tokens
        common = told > 0
        # Divergence test: each occurrence is predicted from the others, by the state
        # and by its suffix (whose probability was sent in sixths of a bit).
        p = np.exp2(bits[order][first] / -6.0)
        known = np.where(common, kinds * shards, kinds)[of_context] - (sums == 1)
        own = (np.maximum(sums - 1 - DISCOUNT, 0) + (DISCOUNT * known + PRIOR) * p) / (total[of_context] - 1 + PRIOR)
        left_out = np.bincount(of_context, sums * np.log(own / p))
        state = (left_out >= GAIN) | common
        # A common context's next tokens lie in all shards: its kinds and this gain are added up later.
        shared = np.flatnonzero(common)
        stats = np.stack([c[new_context][shared], kinds[shared], np.rint(left_out[shared])], 1).astype(np.int64).ravel().tolist()
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new_pair) - 1
        counts, flags = sums[back], np.where(state, np.maximum(kinds, 1), 0)[of_context][back]
        out, at = [], 0
        for b, s, r in zip(group["batch"], group["shard"], rows):
            size = len(r[3])
            heads = at + np.cumsum(r[2]) - r[2]
            out.append((b, step, s, None, _pack(counts[at : at + size].astype(np.int32)), _pack(flags[heads].astype(np.int32)), stats if at == 0 else None))
            at += size
        return pd.DataFrame(out, columns=ANSWER)

    return run


def _order(shard: np.ndarray, context: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Order by (shard, context, follow), none negative; rows equal in all three in any order.

    Contexts are ranked, so that two sorts of one number each do it.
    """
    by_context = np.argsort(context)
    c = context[by_context]
    rank = np.empty(len(c), np.int64)
    rank[by_context] = np.cumsum(np.append(False, c[1:] != c[:-1]))[: len(c)]
    bits = [int(v.max()).bit_length() if len(v) else 0 for v in (shard, rank, follow)]
    if sum(bits) > 63:
        return np.lexsort((follow, context, shard))
    return np.argsort((shard.astype(np.int64) << (bits[1] + bits[2])) | (rank << bits[2]) | follow)


def _summed(gaps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Numbers from their differences; each run begins anew."""
    start = np.cumsum(runs) - runs
    sums = np.cumsum(gaps)
    return sums - np.repeat(sums[start] - gaps[start], runs)


KEYS_SQL = "batch long, shard int, context binary, times binary, runs binary, next binary, n binary, bits binary"
KEYS = ["batch", "shard", "context", "times", "runs", "next", "n", "bits"]


class _Batch:
    """A batch's tokens and what the shards have told about them so far."""

    def __init__(self, row, told: pd.DataFrame, shards: int, tokens: int, distinct: int, common: dict[int, dict[int, int]]):
        self.shards, self.tokens = shards, tokens
        self.codes, self.sizes = _unpack(row.codes, np.int32).astype(np.int64), np.asarray(row.sizes)
        self.ids, self.held = list(row.ids), np.asarray(row.held, bool)
        told = told.sort_values(["step", "shard"])
        words = told[told["step"] == 1]
        order = np.argsort(_unpack(row.shards, np.int32), kind="stable")
        self.word, self.times = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        self.word[order] = np.concatenate([_unpack(x, np.int64) for x in words["word"]])
        self.times[order] = np.concatenate([_unpack(x, np.int64) for x in words["counts"]])
        self.base = (self.times[self.codes] + 0.1) / (tokens + 0.1 * (distinct + 1))
        self.p = self.base.copy()
        self.first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.codes)) - np.repeat(self.first, self.sizes)
        self.train = np.repeat(~self.held, self.sizes)
        # Order-1 context of a token: the word before, or the start (number 0; words count from 1).
        before = np.append(0, self.word[self.codes[:-1]] + 1)
        self.context = np.where(self.place > 0, before, 0)
        ends = self.times[self.codes[-1]]  # a text has one start and one end
        self.context_times = np.where(self.place > 0, np.append(0, self.times[self.codes[:-1]]), ends)
        for step in (2, 3):
            mine = told[told["step"] == step]
            if len(mine):
                self._hear(mine, common[step])

    def pairs(self) -> tuple[np.ndarray, ...]:
        """Distinct (shard, context, next) of the tested contexts, in shard order."""
        usable = np.flatnonzero(self.context_times >= LEAST)
        context, follow = self.context[usable], self.word[self.codes[usable]] + 1
        shard = (context ^ (context >> 29)) * 0x9E3779B1 >> 12
        common = self.context_times[usable] * COMMON >= self.tokens
        shard = np.where(common, shard + follow, shard) % self.shards
        order = _order(shard, context, follow)
        s, c, f = shard[order], context[order], follow[order]
        new = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]) | (f[1:] != f[:-1])) if len(s) else np.zeros(0, bool)
        return usable, order, s, c, f, new

    def ask(self) -> Iterator[tuple]:
        usable, order, s, c, f, new = self.pairs()
        if not len(s):
            return
        head = np.flatnonzero(new)
        n = np.add.reduceat(self.train[usable][order].astype(np.int64), head).astype(np.int32)
        bits = np.minimum(np.rint(-6 * np.log2(self.p[usable][order][head])), 255).astype(np.uint8)
        times = self.context_times[usable][order][head]
        times = np.where(times * COMMON >= self.tokens, times, 0)
        s, c, f = s[head], c[head], f[head]
        ends = np.append(np.flatnonzero(np.append(True, s[1:] != s[:-1])), len(s))
        for a, b in zip(ends[:-1], ends[1:]):
            start = np.flatnonzero(np.append(True, c[a + 1 : b] != c[a : b - 1]))
            runs = np.diff(np.append(start, b - a)).astype(np.int32)
            gaps = np.diff(f[a:b], prepend=0)
            gaps[start] = f[a:b][start]
            yield int(s[a]), _pack(np.diff(c[a:b][start], prepend=0)), _pack(times[a:b][start]), _pack(runs), _pack(gaps), _pack(n[a:b]), _pack(bits[a:b])

    def _hear(self, told: pd.DataFrame, common: dict[int, int]) -> None:
        """Takes the answers to ``ask`` and moves on to contexts one token longer."""
        usable, order, s, c, f, new = self.pairs()
        counts = np.concatenate([_unpack(x, np.int32) for x in told["counts"]]).astype(np.int64)
        kinds = np.concatenate([_unpack(x, np.int32) for x in told["flags"]])
        head = np.flatnonzero(new)
        new_context = np.append(True, (s[head][1:] != s[head][:-1]) | (c[head][1:] != c[head][:-1]))
        pair_count = np.zeros(len(self.codes), np.int64)
        pair_count[usable[order]] = counts[np.cumsum(new) - 1]
        contexts = c[head][new_context]
        for context, number in common.items():
            kinds[contexts == context] = number
        states, at = np.unique(contexts[kinds > 0], return_index=True)
        if len(states):
            kinds = kinds[kinds > 0][at]
            at = np.minimum(np.searchsorted(states, self.context), len(states) - 1)
            state = (states[at] == self.context) & (self.context_times >= LEAST)
            rest = DISCOUNT * kinds[at] + PRIOR
            mixed = (np.maximum(pair_count - DISCOUNT, 0) + rest * self.p) / (self.context_times + PRIOR)
            self.p = np.where(state, mixed, self.p)
        # A longer context is tried only where its suffix is a state's pair seen often enough.
        longer, times = np.zeros_like(self.context), np.zeros_like(self.context)
        ahead = self.place > 0
        last = np.flatnonzero(ahead) - 1
        longer[ahead] = (self.context[last] << 32) | (self.word[self.codes[last]] + 1)
        times[ahead] = pair_count[last]
        self.context, self.context_times = longer, times


def score_texts(documents: DataFrame, held_out: Column, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Base and model log10 probability of every text.

    The model learns from the rows where ``held_out`` is not true (null counts
    as false) and scores all. Columns: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. Repeated rows are scored, and learned from,
    each time; null keys are kept; a null text is empty (one token, the end);
    other columns are ignored; an empty table gives no rows.

    No word or context is hot: a batch names each only once, however often it
    occurs, and a context with 1/COMMON of all tokens has its next tokens dealt
    over all shards. Words are numbered below 2^31.
    """
    spark = documents.sparkSession
    shards = tasks(spark)
    stored, name = scratch_path(spark, "tokens"), f"tokens_{uuid.uuid4().hex}"
    rows = documents.select(F.col(doc).cast("long"), whole_text(text).cast("binary"), F.coalesce(held_out, F.lit(False)))
    coded = rows.mapInArrow(lambda t: _batches(t, shards), BATCH_SQL)
    # Bucketed by batch, so the answers of each step travel to the batches and not the batches to them.
    coded = coded.withColumn("of_words", F.col("shard") >= 0)
    (coded.write.option("compression", "zstd").option("path", stored).partitionBy("of_words").bucketBy(shards, "batch").saveAsTable(name))
    table = spark.table(name)
    texts = table.where("not of_words").select("batch", "ids", "held", "sizes", "codes", "shards")

    def kept(df: DataFrame, schema: str, what: str) -> DataFrame:
        path = scratch_path(spark, what)
        with shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(schema).parquet(path)

    words = table.where("of_words").select("batch", "shard", "words", "seen")
    answers = kept(words.groupBy("shard").applyInPandas(_count_words(shards), ANSWER_SQL), ANSWER_SQL, "words")
    # The words are numbered now and not read again: an empty write takes their folder's place.
    spark.createDataFrame([], "none int").write.mode("overwrite").parquet(f"{stored}/of_words=true")
    sizes = answers.agg(F.sum(F.get("stats", F.lit(0))).alias("n"), F.sum(F.get("stats", F.lit(1))).alias("v")).first()
    tokens, distinct = int(sizes["n"] or 0), int(sizes["v"] or 0)

    common: dict[int, dict[int, int]] = {}

    def ask(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            [(r.batch, *k) for r in rows.itertuples() for k in _Batch(r, told, shards, tokens, distinct, common).ask()], columns=KEYS
        )

    def add_up(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in rows.itertuples():
            b = _Batch(r, told, shards, tokens, distinct, common)
            known = (b.times > 0)[b.codes].astype(np.int64)
            out.append(pd.DataFrame({
                "doc_id": pd.array(b.ids, "Int64"), "held_out": b.held, "n_tokens": b.sizes.astype(np.int64),
                "n_known": np.add.reduceat(known, b.first), "train_tokens": tokens,
                "base_score": np.add.reduceat(np.log10(b.base), b.first), "score": np.add.reduceat(np.log10(b.p), b.first),
            }))
        return pd.concat(out, ignore_index=True)

    meet = lambda run, schema: texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(run, schema)
    for step in (2, 3):
        asked = meet(ask, KEYS_SQL).groupBy("shard").applyInPandas(_test_contexts(step, tokens, shards), ANSWER_SQL)
        told = kept(asked, ANSWER_SQL, f"contexts{step}")
        # At most COMMON contexts, and a row for each shard.
        common[step] = {}
        for row in told.where(F.size("stats") > 0).select("stats").collect():
            for context, kinds, gain in zip(row["stats"][::3], row["stats"][1::3], row["stats"][2::3]):
                before = common[step].get(context, (0, 0))
                common[step][context] = (before[0] + kinds, before[1] + gain)
        common[step] = {c: kinds if gain >= GAIN else 0 for c, (kinds, gain) in common[step].items()}
        answers = answers.unionByName(told)
    return meet(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
