"""The best rows are those of scoring every row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from restock.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id long, q string, segment int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "q", 1) for i, v in rows], SCHEMA)


def run(spark, rows, every=5, k=3):
    segments = topk.index(frame(spark, rows).repartition(3), F.col("embedding"), "vec_id")
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in topk.search(segments, every, k).collect())


def brute(rows, every=5, k=3):
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    asked = {}
    for i, v in whole:
        if i is not None and i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = sorted(((-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0, j) for j, v in whole if j != i))
        out += [(i, n, j, -s) for n, (s, _, _, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(topk, "SEGMENT_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 10)
    monkeypatch.setattr(topk, "PIVOTS", 6)
    monkeypatch.setattr(topk, "PART_SEGMENTS", 3)


@pytest.mark.parametrize("spread", [0.02, 1.0, 1000.0])
def test_against_every_row(spark, spread):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, spread, 6)]) for i in rng.permutation(300)]
    assert run(spark, rows) == brute(rows)


def test_awkward(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None), (4, []), (5, [0.1, None]), (6, [float("nan"), 1.0]), (10, [float("inf"), 1.0])]
    rows += [(None, [0.5, 0.25]), (None, [0.5, 0.25]), (15, [-1.0]), (15, [-1.0]), (20, [1.0, 1.0, 9.0]), (20, [0.0, 1.0]), (7, [3.0, -2.0, 1.0, 4.0])]
    assert run(spark, rows) == brute(rows)


def test_few_rows_or_none(spark):
    assert run(spark, [(0, [1.0]), (5, [2.0])]) == [(0, 1, 5, 131072), (5, 1, 0, 131072)]
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_one_vector_very_often(spark):
    rows = [(i, [0.5, -0.5, 0.25]) for i in range(400)] + [(400 + i, [i / 100, 0.5, -0.25]) for i in range(100)]
    assert run(spark, rows, every=25) == brute(rows, every=25)


def test_large_components():
    big = np.array([[2**30, 3], [5, -(2**30)]])
    assert topk.products(big, big).tolist() == [[2**60 + 9, 2 * 2**30], [2 * 2**30, 25 + 2**60]]
    with pytest.raises(OverflowError):
        topk.products(big * 8, big)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    vectors, queries = rng.integers(-99, 99, (100, 5)), rng.integers(-99, 99, (30, 5))
    high, low = topk._limits(vectors)
    scores = topk.products(queries, vectors)
    bounds = topk._bounds(queries, high, low)
    for b in range(bounds.shape[1]):
        assert (scores[:, b * 8 : b * 8 + 8].max(1) <= bounds[:, b]).all()
