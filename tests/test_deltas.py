"""Aggregates brought up to date equal those computed anew, and only touched groups are aggregated again."""

import random

import pytest
from pyspark.sql import functions as F

from restock.operators import deltas
from restock.sources.keyed import KeyedStore

SCHEMA = "id int, g string, h int, v bigint, d date"


@pytest.fixture
def shape(spark):
    return deltas.Aggregates(["g", "h"], {"total": F.col("v"), "many": F.lit(1)}, {"first": F.col("d")}, {"last": F.col("d"), "top": F.coalesce("v", F.lit(0))})


def test_refreshed_groups_equal_a_recompute(spark, tmp_path, shape):
    rng = random.Random(2)

    def row(i):
        day = f"2024-01-{rng.randrange(1, 29):02d}" if rng.random() < 0.9 else None
        return (i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.randrange(-5, 6), day)

    def frame(rows):
        return spark.createDataFrame(list(rows), "id int, g string, h int, v bigint, d string").withColumn("d", F.to_date("d"))

    table = {i: row(i) for i in range(60)}
    ledger = KeyedStore(spark, str(tmp_path / "ledger"), frame([]).schema, "id", buckets=4).replace(frame(table.values()))
    store = KeyedStore(spark, str(tmp_path / "cells"), deltas.schema(shape, frame([])), deltas.CELL, buckets=4)
    deltas.start(store, shape, ledger.current())
    for step in range(3):
        seen = ledger.head()
        fresh = {i: row(i) for i in [*rng.sample(sorted(table), 6), 100 + step]}
        gone = rng.sample(sorted(table), 8) if step < 2 else [i for i in table if table[i][1] == "a"]
        ledger.upsert(frame(fresh.values()), frame([(i, None, None, None, None) for i in gone]))
        table = {i: r for i, r in table.items() if i not in gone} | fresh
        before, after = ledger.changes(seen)
        deltas.refresh(store, shape, before, after, ledger.current())
        expected = sorted(map(str, shape.full(frame(table.values())).collect()))
        assert sorted(map(str, store.current().select(*shape.full(frame([])).columns).collect())) == expected


def test_a_lost_end_is_looked_up_in_its_own_group_only(spark, tmp_path, shape):
    rows = spark.createDataFrame([(1, "a", 1, 5, None), (2, "a", 1, 7, None), (3, "b", 1, 9, None)], "id int, g string, h int, v bigint, d date")
    store = KeyedStore(spark, str(tmp_path / "s"), deltas.schema(shape, rows), deltas.CELL, buckets=2)
    deltas.start(store, shape, rows)
    again = deltas.refresh(store, shape, rows.filter("id = 2"), rows.filter("id = -1"), rows.filter("id <> 2"))
    assert [r.g for r in again.collect()] == ["a"]
    again = deltas.refresh(store, shape, rows.filter("id = -1"), rows.filter("id = 2"), rows)
    assert again.collect() == []
    assert {(r.g, r.top, r.total) for r in store.current().collect()} == {("a", 7, 12), ("b", 9, 9)}
