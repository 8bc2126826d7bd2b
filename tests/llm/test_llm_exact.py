"""Equal texts get one name, others different ones; the row with the smallest id stays."""

import hashlib
import random
import re

import pytest
import samples
from pyspark.sql import functions as F

from restock.llm import exact


def brute(rows):
    body = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), b in zip(rows, body, strict=True):
        ids = [j for (j, _), c in zip(rows, body, strict=True) if c == b]
        known = [j for j in ids if j is not None]
        out.append((i, min(known) if known else None, len(ids), hashlib.sha256(b.encode()).hexdigest()))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = exact.groups(df, **options).collect()
    assert sorted(map(str, [(r.id, r.keep_id, r.group_size, r.text_sha256) for r in found])) == sorted(map(str, brute(rows)))
    kept = [r for r in found if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in found})
    assert all(r.id == r.keep_id for r in kept)


def test_awkward(spark):
    check(spark, [(i, t) for i, t, _ in samples.TEXTS])


def test_no_rows(spark):
    assert exact.groups(samples.none(spark)).collect() == []
    assert exact.deduplicate(samples.none(spark)).collect() == []


@pytest.mark.parametrize("block_bytes", [1, 3, 4096])
def test_many_levels(spark, block_bytes):
    rng = random.Random(block_bytes)
    texts = ["".join(rng.choice("ab é\n") for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9, 30]))) for _ in range(120)]
    check(spark, [(rng.choice([None, *range(90)]), rng.choice(texts)) for _ in range(200)], block_bytes=block_bytes)


def test_a_text_and_its_beginning_differ(spark):
    check(spark, [(i, "ab" * i) for i in range(40)] + [(50 + i, "ab" * i) for i in range(0, 40, 3)], block_bytes=2)


def test_blocks_that_meet_are_told_apart(spark):
    """Routes that bring different blocks together are dropped for others."""
    tried = []

    def weak(seed, block):
        tried.append(seed)
        return [F.length(block).cast("bigint") if seed < 2 else F.xxhash64(F.lit(seed), block)]

    check(spark, [(i, t) for i, t in enumerate(["aa", "bb", "aa", "cc", "ccdd", "aadd"])], route=weak)
    assert max(tried) == 2


def test_rows_that_stay_keep_their_columns(spark):
    rows = samples.awkward(spark)
    found = exact.deduplicate(rows)
    assert found.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.at) for r in found.collect()) == [
        (False, i, "?") for i in (-3, 0, 1, 3, 6, 7, 8, 9, 11)
    ] + [(True, 0, "?")]
