"""Shards hold every row once, in exact sizes, in an order that does not follow the input."""

from collections import Counter

import pytest
import samples

from restock.llm.sharding import shard


def test_awkward_rows_are_all_there(spark):
    rows = samples.awkward(spark)
    found = shard(rows, 5)
    assert [c for c in found.columns if c not in ("shard", "slot")] == [c for c in rows.columns if c not in ("shard", "slot")]
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter((r.doc_id, r.text) for r in rows.collect())
    _exact(found, rows.count(), 5)


def _exact(found, total, shards):
    slots: dict[int, list[int]] = {j: [] for j in range(shards)}
    for r in found.select("shard", "slot").collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(len(s) for s in slots.values()) == sorted(total // shards + (j < total % shards) for j in range(shards))


def test_no_rows(spark):
    assert shard(samples.none(spark), 4).collect() == []


@pytest.mark.parametrize(("rows", "parts"), [(3, 2), (5003, 9), (4000, 1)])
def test_sizes(spark, rows, parts, monkeypatch):
    monkeypatch.setattr("restock.llm.sharding.BUCKET_ROWS", 50)
    found = shard(spark.range(0, rows, 1, parts), 7)
    _exact(found, rows, 7)


def test_order_is_shuffled(spark):
    found = shard(spark.range(0, 20_000, 1, 8), 4).collect()
    for j in range(4):
        own = [r.id for r in sorted((r for r in found if r.shard == j), key=lambda r: r.slot)]
        assert abs(sum(i < 10_000 for i in own) / len(own) - 0.5) < 0.04
        assert abs(sum(a < b for a, b in zip(own, own[1:], strict=False)) / len(own) - 0.5) < 0.04


def test_one_partition_goes_to_all_shards_as_the_law_says(spark):
    """Over seeds, the share of the first partition in a shard has the hypergeometric mean and spread."""
    counts = []
    for seed in range(12):
        counts += Counter(r.shard for r in shard(spark.range(0, 400, 1, 4), 4, seed).filter("id < 100").collect()).values()
    mean = sum(counts) / 48
    spread = sum((c - 25) ** 2 for c in counts) / 48
    assert mean == 25 and 6 < spread < 28  # 100 of 400 in 4 shards: the variance is 14.1
