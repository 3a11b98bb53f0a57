"""Hard negatives against plain Python, and the parts of the method by themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from topicloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, row string, k string, v string, part string"


def mined(spark, rows, **options):
    df = spark.createDataFrame([(k, v, y, "x", "x", "x", "x", "x") for k, y, v, _ in rows], SCHEMA)
    got = negatives.hard_negatives(df, anchors=F.col("vec_id") % 5 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def with_anchor(rows):
    return [(k, y, v, k is not None and k % 5 == 0) for k, y, v in rows]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (17, 16, 40), (65, 33, 129), (64, 64, 64), (5, 0, 3), (100, 1, 100)])
def test_strassen(shape):
    m, k, n = shape
    rng = np.random.default_rng(m + k + n)
    a, b = rng.integers(-2 ** 25, 2 ** 25, (m, k)), rng.integers(-2 ** 25, 2 ** 25, (k, n))
    want = (a.astype(object) @ b.astype(object)) if k else np.zeros((m, n), object)
    for leaf in (1, 4, 16):
        assert (negatives.strassen(a, b, leaf) == want).all()


def test_strassen_is_exact_at_the_border_of_a_long():
    a, b = np.full((32, 32), 2 ** 28, np.int64), np.full((32, 32), 2 ** 28, np.int64)
    b[:, ::2] *= -1
    assert (negatives.strassen(a, b, 1) == a @ b).all() and abs(int((a @ b)[0, 0])) == 2 ** 61


def test_heaps_merge():
    rng = np.random.default_rng(2)
    slot, score = rng.integers(0, 9, 500), rng.integers(-5, 5, 500)
    place = rng.permutation(500)
    want = [sorted(((-s, p) for t, s, p in zip(slot, score, place) if t == x))[:4] for x in range(9)]
    whole, left, right = (negatives.Heaps(9, 4) for _ in range(3))
    whole.offer(slot, score, place)
    left.offer(slot[:200], score[:200], place[:200])
    right.offer(slot[200:], score[200:], place[200:])
    left.offer(right.slot, right.score, right.place)
    for heap in (whole, left):
        assert [[(-s, p) for t, s, p in zip(heap.slot, heap.score, heap.place) if t == x] for x in range(9)] == want
        assert heap.least.tolist() == [-w[-1][0] for w in want]


def test_odd_rows(spark):
    """Nulls, non-finite and huge components, ragged vectors, ties, repeated keys and rows, clashing column names."""
    rng = np.random.default_rng(0)
    rows = [(int(k), int(rng.integers(0, 3)), [float(x) for x in rng.integers(-3, 6, 4) / 4]) for k in range(60)]
    rows += [(60, None, [1.0, 1.0]), (61, 1, None), (62, 1, [None, 1.0]), (63, 1, [float("nan"), 1.0]), (65, 2, [float("inf"), 0.0]), (66, 1, []),
             (67, 0, [1.0]), (68, 0, [1e300, 1.0]), (70, 0, [1e7, 1.0]), (75, 2, [2.0 ** 22, 2.0 ** 21, 0.5]), (76, 1, [2.0 ** 22, 0.0]),
             (78, 2, [1e-9, -1e-9, 1.0]), (None, 0, [0.5, 1.0]), (None, 1, [0.75, 1.0, 0.25]), (5, rows[5][1], rows[5][2]), (5, 2, [1.0, 1.0, 1.0])]
    got, want = mined(spark, with_anchor(rows)), brute.negatives(with_anchor(rows))
    assert want and got == want


def test_a_hot_label_in_many_tiles(spark, monkeypatch):
    """One label holds a third of all rows and is cut into blocks, small labels share a part, anchors come in several waves."""
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 4)
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(negatives, "BLOCKS_AT_ONCE", 2)
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.integers(1, 30)) if k % 3 else 0, [float(x) for x in rng.integers(-2, 4, 9) / 2]) for k in range(200)]
    got, want = mined(spark, with_anchor(rows), positives=4, negatives=2), brute.negatives(with_anchor(rows), 4, 2)
    assert len(want) > 200 and got == want


def test_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(5, 1, [1.0], True)]) == []
    assert mined(spark, [(1, 1, [1.0], False), (2, 1, [1.0], False)]) == []
