"""Quality classifier: supervised embeddings of hashed words and character n-grams.

Every word, every 3- to 5-gram of bytes inside a word (with its bounds) and the
repetition of the word before have learned vectors; a document is the mean of its vectors, a softmax over two
outputs gives the score. Trained with stochastic gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.llm.common import slices, whole_text

BUCKETS = 1 << 18
WIDTH = 12
SIZES = (3, 4, 5)
SAMPLE_ROWS = 6_000  # labelled rows the classifier is fitted on at most
SAMPLE_CHARS = 40_000_000  # and their characters in all
EPOCHS = 4
RATE = 0.4
CHUNK = 1_000_000  # bytes hashed at a time

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x100000001B3)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - 18)).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of some texts, and the text of each."""
    joined = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[joined]
    codes = np.where(space, 32, joined).astype(np.uint64)
    out, at = [], []
    # Words: a polynomial of their bytes, summed between white space.
    inside = np.flatnonzero(~space)
    if len(inside):
        new = np.append(True, np.diff(inside) > 1)
        starts = inside[new]
        place = inside - starts[np.cumsum(new) - 1]
        with np.errstate(over="ignore"):
            power = np.cumprod(np.append(np.uint64(1), np.full(int(place.max()), _STEP)))
            words = np.add.reduceat(codes[inside] * power[place], np.flatnonzero(new)) + np.uint64(7)
        # A word that repeats the one before it is also a word of its own kind.
        again = np.flatnonzero(words[1:] == words[:-1]) + 1
        again = again[np.searchsorted(ends, starts[again], side="right") == np.searchsorted(ends, starts[again - 1], side="right")]
        out += [_mix(words), np.zeros(len(again), np.int32)]
        at += [starts, starts[again]]
    # n-grams: no white space inside, at most one on each side.
    gaps = np.cumsum(space)
    for n in SIZES:
        if len(codes) < n:
            continue
        with np.errstate(over="ignore"):
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                h = h * _STEP + codes[i : len(codes) - n + 1 + i]
        whole = gaps[1 : len(codes) - n + 2] == gaps[n - 2 : len(codes) - 1] if n > 2 else np.ones(len(h), bool)
        # None begins in one text and ends in another: a text's features are its own.
        across = (ends[:-1, None] - np.arange(1, n - 1)).ravel()
        whole[across[(across >= 0) & (across < len(h))]] = False
        whole = np.flatnonzero(whole)
        out.append(_mix(h[whole]))
        at.append(whole)
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.minimum(np.searchsorted(ends, np.concatenate(at), side="right"), len(texts) - 1)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of at most about CHUNK bytes, cut between words where it has any."""
    at = 0
    while len(text) - at > CHUNK:
        cut = max(text.rfind(b" ", at, at + CHUNK), text.rfind(b"\n", at, at + CHUNK))
        cut = cut if cut > at else at + CHUNK
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def train(texts: list[bytes], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Fits the embeddings; returns each bucket's pull on the difference of the
    two outputs, and the bias. (The mean of vectors is linear, so a bucket's
    vector times the output weights is all that scoring needs.)"""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    rows = []
    for text, label in zip(texts, labels):
        buckets, times = np.unique(features([text])[0], return_counts=True)
        if len(buckets):
            rows.append((buckets, (times / times.sum()).astype(np.float32), int(label)))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for n in rng.permutation(len(rows)):
            buckets, share, label = rows[n]
            mean = share @ vectors[buckets]
            out = mean @ weights + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[label] -= 1
            pull = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # Each bucket moves by its share, scaled up as shares are small.
            vectors[buckets] -= (rate * np.minimum(1.0, share * 50))[:, None] * pull
    return vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def fit(documents: DataFrame, labels: DataFrame, learn_from: Column, doc: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Trains on at most ``rows`` labelled documents, taken by the hash of their keys.

    Only keys where ``learn_from`` holds are used; rows without a label or key
    are not. Texts beyond SAMPLE_CHARS in all are left out of the fit. Only
    this sample comes to the driver. Without labelled rows, every score is 0.5.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull() & learn_from)
        .groupBy(doc)
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64(doc), doc)
        .limit(rows)
    )
    sizes = documents.select(F.col(doc), whole_text(text).alias("_text"))
    sample = sizes.join(F.broadcast(chosen), doc).where(F.length("_text") > 0)
    # Long texts may not crowd the driver: the running size is taken before texts move.
    # A key that repeats counts once, with its shortest text.
    one = F.min(F.struct(F.length("_text").alias("n"), F.xxhash64("_text").alias("h"))).alias("_one")
    lengths = sample.groupBy(doc).agg(one).select(doc, "_one.*").collect()
    total, wanted = 0, []
    for r in sorted(lengths, key=lambda r: (r["h"], r[doc])):
        if total + r["n"] <= SAMPLE_CHARS:
            total += r["n"]
            wanted.append((r[doc], r["h"]))
    picked = documents.sparkSession.createDataFrame(wanted, f"{doc} long, _h long").distinct()
    texts = sample.withColumn("_h", F.xxhash64("_text")).join(F.broadcast(picked), [doc, "_h"]).dropDuplicates([doc, "_h"])
    texts = texts.select(F.encode("_text", "utf-8").alias("t"), "_label", doc).collect()
    texts.sort(key=lambda r: (r[doc], r["t"]))  # the order of training doesn't depend on partitions
    return train([bytes(r["t"]) for r in texts], np.array([r["_label"] for r in texts], int))


def score(documents: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``documents`` and the probability of label 1.

    Depends on the text alone; a null text is empty, an empty one gets the score
    of the bias. Long texts are hashed in parts and whole. An existing column of
    that name is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in documents.columns if c != name]
    schema = documents.select(*rest).schema.add(name, "double")
    at = rest.index(text)  # the text travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pulls, bias = shared.value
        for b in slices(batches, at):
            pieces = [(n, p) for n, t in enumerate(b.column(at).cast(pa.binary())) if t.is_valid for p in _pieces(t.as_py())]
            sums, counts = np.zeros(b.num_rows), np.zeros(b.num_rows)
            first = 0
            while first < len(pieces):
                last, size = first, 0
                while last < len(pieces) and (size == 0 or size + len(pieces[last][1]) <= CHUNK):
                    size += len(pieces[last][1])
                    last += 1
                buckets, piece = features([p for _, p in pieces[first:last]])
                row = np.array([n for n, _ in pieces[first:last]])[piece]
                sums += np.bincount(row, pulls[buckets], b.num_rows)
                counts += np.bincount(row, minlength=b.num_rows)
                first = last
            value = 1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + bias)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(value)], names=[*rest, name])

    return documents.select(*rest).mapInArrow(run, schema)
