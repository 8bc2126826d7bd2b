"""Draws without replacement follow their law, and the tree's sums are exact."""

from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from restock.llm.draws import hypergeometric, split


@pytest.mark.parametrize(("total", "good", "draws"), [(20, 7, 5), (20, 19, 20), (10, 0, 4), (10, 10, 4), (1, 1, 1), (0, 0, 0), (60, 30, 30)])
def test_the_law(spark, total, good, draws):
    n = 4000
    count = [F.lit(x).cast("bigint") for x in (total, good, draws)]
    found = Counter(r[0] for r in spark.range(n).select(hypergeometric(*count, (F.col("id") + 0.5) / n)).collect())
    for k in range(good + 1):
        p = comb(good, k) * comb(total - good, draws - k) / comb(total, draws) if 0 <= draws - k <= total - good else 0
        assert abs(found.get(k, 0) / n - p) <= 2 / n


def test_large_counts_stay_within_their_bounds(spark):
    count = [F.lit(x).cast("bigint") for x in (10**12, 3 * 10**11, 10**10)]
    found = sorted(r[0] for r in spark.range(9).select(hypergeometric(*count, (F.col("id") + 0.5) / 9)).collect())
    assert abs(found[4] - 3 * 10**9) < 100 and found[0] > 3 * 10**9 - 250_000 and found[-1] < 3 * 10**9 + 250_000


@pytest.mark.parametrize("sizes", [[5], [3, 0, 4], [7] * 40, list(range(300))])
def test_sums_are_exact(spark, sizes):
    pools = [sum(sizes) // 3, 0, sum(sizes) - sum(sizes) // 3]
    leaves = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n or i % 2], "leaf long, size long")
    row = spark.createDataFrame([(pools,)], "pools array<bigint>")
    found = {r.leaf: r.quota for r in split(leaves, row, len(sizes), 3, fan=5).collect()}
    assert [sum(found.get(i, [0])) for i in range(len(sizes))] == sizes
    assert [sum(q[j] for q in found.values()) for j in range(3)] == pools
    assert all(x >= 0 for q in found.values() for x in q)
