"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamframe.llm import hard_negatives as hn

VECTORS = "vec_id long, label int, embedding array<float>"


def brute(rows, positives=5, negatives=5, low=80, high=100, every=100):
    kept = {}
    for key, label, v in rows:
        if key is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        kept[key] = min(kept.get(key, row), row)
    width = max((len(v) for _, v in kept.values()), default=0)
    dot = lambda a, b: sum(x * y for x, y in zip(a + [0] * (width - len(a)), b + [0] * (width - len(b))))
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted(((-dot(v, w), k, other) for k, (other, w) in kept.items() if k != a))
        for s, p, other in [r for r in scored if r[2] == label][:positives]:
            fits = [(k, -t) for t, k, o in scored if o != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, p, n, k, -s, t) for n, (k, t) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every=100, **how):
    df = spark.createDataFrame(rows, VECTORS).withColumns({"tile": F.lit("t"), "v": F.lit(1), "ids": F.lit("i"), "score": F.lit(0)})
    found = hn.mine_hard_negatives(hn.labelled_vectors(df, F.col("label")), F.col("vec_id") % every == 0, **how)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("block, leaf", [(1024, 32), (64, 4)])
def test_random_vectors(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 4)), (centres[rng.integers(0, 6)] + 0.3 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(900)]
    expected = brute(rows, every=50)
    assert expected and mined(spark, rows, every=50) == expected
    if block == 64:
        some = dict(positives=2, negatives=3, least_percent=50, most_percent=90)
        assert mined(spark, rows, every=50, **some) == brute(rows, 2, 3, 50, 90, every=50)


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, [0.5, 0.25, -0.5]) for i in range(0, 400)]
    rows += [(i, i % 3, rng.normal(size=3).astype(np.float32).tolist()) for i in range(400, 700)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 5.0]), (3, 2, [0.9, 0.0]), (3, 2, [0.9, 0.0]), (3, 1, [0.95]), (4, 2, [0.8, 1.0]),
        (5, None, [1.0, 1.0]), (6, 2, None), (7, 2, []), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (10, 2, [None, 1.0]), (None, 2, [1.0, 1.0]),
        (100, 3, [-1.0, 0.0]), (200, 3, [1.0, 0.0]), (300, 4, [0.0, 0.0]), (400, 4, [0.0, 0.0]), (-100, 7, [1.0, 2.0]), (11, 2, [1.0]),
        (500, 9, [30000.0, 1.0]), (12, 9, [29000.0, 1.0]), (13, 8, [29000.0, -1.0]),
    ]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows[:1]) == [] == mined(spark, [])
    assert mined(spark, rows[1:8]) == []  # no anchor


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (rng.normal(size=2) * 1e6).astype(np.float32).tolist()) for i in range(60)]
    big = [(k, n, [x * 1.0 for x in v]) for k, n, v in rows]
    assert mined(spark, big, every=10) == brute(big, every=10)


def test_bounds_hold_and_close_the_search():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-50, 50, (700, 4)) + 300 * c for c in range(-2, 3)])
    order = hn.packed_order(x)
    assert sorted(order.tolist()) == list(range(len(x)))
    tree = hn.Tree.of(x[order], np.arange(len(x)), np.zeros(len(x), int))
    assert tree.sizes[-1] == 1 and (tree.low[-1] == x.min(0)).all() and (tree.high[-1] == x.max(0)).all()
    q = rng.integers(-9, 9, (5, 4))
    least, most = hn.intervals(q, tree.low, tree.high)
    for n in range(5):
        scores = tree.x @ q[n]
        for leaf in range(tree.sizes[0]):
            part = scores[leaf * hn.LEAF_ROWS : (leaf + 1) * hn.LEAF_ROWS]
            assert least[n, leaf] <= part.min() and part.max() <= most[n, leaf]
        best = hn.Best(hn.LEAST, hn.MOST, None, 5)
        opened = hn.search(tree, q[n], least[n], most[n], np.ones(len(x), bool), [best])
        assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:5]
        assert opened < tree.sizes[0] / 2  # clusters far apart are never opened
        middle = int(np.median(scores))
        window = hn.Best(middle - 3, middle, None, 5)
        hn.search(tree, q[n], least[n], most[n], np.ones(len(x), bool), [window])
        assert window.scores.tolist() == sorted((s for s in scores.tolist() if middle - 3 <= s <= middle), reverse=True)[:5]


def test_the_driver_holds_no_table(spark, monkeypatch):
    """the sample comes to the driver as few rows from every task, and no join broadcasts blocks, anchors or windows."""
    monkeypatch.setattr(hn, "SAMPLE", 100)
    ordered, limit = [], type(spark.range(1)).limit

    def counted(df, n):
        ordered.append(df.count())
        return limit(df, n)

    monkeypatch.setattr(type(spark.range(1)), "limit", counted)
    rng = np.random.default_rng(6)
    rows = [(i, i % 3, rng.normal(size=4).astype(np.float32).tolist()) for i in range(3000)]
    vectors = hn.labelled_vectors(spark.createDataFrame(rows, VECTORS), F.col("label"))
    found = hn.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)
    assert 100 <= max(ordered) <= 200  # rows that stand before the limit
    assert sorted(map(tuple, found.collect())) == brute(rows)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    whole = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").head(100)
    assert hn._sampled(vectors, 3000).collect() == whole


@pytest.mark.parametrize("kind", ["i1", "i2", "i4", "i8"])
def test_packed_numbers_come_back(kind):
    """blocks hold their numbers in the least width, up to its ends."""
    ends = np.iinfo(kind)
    x = np.array([[ends.min, 0, 1], [ends.max, -1, 2]], np.int64)
    assert len(hn.packed(x)) == x.size * np.dtype(kind).itemsize and (hn.unpacked(hn.packed(x), 2, 3) == x).all()
