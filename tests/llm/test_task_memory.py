"""What a task makes of its texts is held for a slice of a batch, not for all of it."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from loamframe.llm import jaccard_join, line_dedup, packing, quality
from loamframe.llm.common import slices
from loamframe.llm.queries import tokenizer_file

TEXT = " ".join(f"word{n % 97} ends. And" if n % 9 == 0 else f"word{n % 97}" for n in range(170))
OPERATORS = {
    "near copies": (lambda d: jaccard_join._signed(d, "doc_id", "text", 24, 5), ("doc_id", "text")),
    "quality": (lambda d: quality.score(d, (np.linspace(-1, 1, quality.BUCKETS).astype(np.float32), 0.1)), ("doc_id", "text")),
    "repeats": (line_dedup.text_units, ("doc_id", "doc_id", "text")),
    "packing": (lambda d: packing.token_pieces(d, tokenizer_file("word_bpe_49k.json")), ("doc_id", "text")),
}


def batch(texts):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_slices_hold_every_row_in_order():
    texts = ["ab", None, "", "x" * 50, "", "cd", "é" * 4, None, "e"]
    whole = [batch(texts), batch([]), batch([None, None]), batch(texts).slice(3, 4)]
    for size in (1, 5, 10, 1000):
        cut = list(slices(iter(whole), 1, size))
        assert [r for b in cut for r in b.to_pylist()] == [r for b in whole for r in b.to_pylist()]
        # A slice goes beyond its size by its last text at most.
        assert all(b.num_rows and sum(len((t or "").encode()) for t in b.column(1).to_pylist()[:-1]) <= size for b in cut)
    assert len(list(slices(iter(whole), 1, 1000))) == 3 and len(list(slices(iter(whole), 1, 10))) > 5


@pytest.mark.parametrize("name", OPERATORS)
def test_memory_does_not_follow_the_batch(spark, monkeypatch, name):
    operator, columns = OPERATORS[name]
    frame, found = spark.createDataFrame([(1, TEXT)], "doc_id long, text string"), []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, function, *rest, **named: found.append(function) or self)
    operator(frame)
    (work,) = found

    def held(rows):
        b = batch([TEXT] * rows)
        given = pa.RecordBatch.from_arrays([b.column(c) for c in columns], names=[f"c{n}" for n in range(len(columns))] if len(set(columns)) < len(columns) else list(columns))
        tracemalloc.start()
        made = sum(out.num_rows for out in work(iter([given])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return made, most

    few = 180_000 // len(TEXT)
    held(few)  # caches are filled
    (made, one), (made_of_many, many) = held(few), held(12 * few)
    assert made_of_many == 12 * made
    assert many < 3 * one, (one, many)


def test_features_do_not_follow_the_neighbours():
    texts = [b"ab", b"", b"x", b" y ", b"a b\nc", b"", b"words and words words", b"z"]
    buckets, whose = quality.features(texts)
    for n, text in enumerate(texts):
        assert sorted(buckets[whose == n]) == sorted(quality.features([text])[0]), text
    assert len(buckets) == len(whose) == sum(len(quality.features([t])[0]) for t in texts)
