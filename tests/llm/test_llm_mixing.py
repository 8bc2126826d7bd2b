"""Targets are those of resharing step by step; what is taken is near them, and does not hang on the layout."""

import re
from collections import Counter, defaultdict

import pytest
import samples

from restock.llm.mixing import WORD, Mix, mix_rows, targets


def reshared(sizes, weights=(3, 1, 2), share=1.5, most=2):
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        left = share * sum(sizes) - sum(most * sizes[i] for i in full)
        rest = sum(w[i] for i in range(len(w)) if i not in full)
        found = [most * sizes[i] if i in full else left * w[i] / rest for i in range(len(w))]
        over = {i for i in range(len(w)) if i not in full and found[i] > most * sizes[i] + 1e-9}
        if not over:
            return found
        full |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [100, 1, 1], [0, 5, 0, 7], [1, 1000, 1, 3, 50, 2, 80], [0, 0], [42]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    found = {r.source: r.target for r in targets(df).collect()}
    assert [found[f"s{i:02}"] for i in range(len(sizes))] == pytest.approx(reshared(sizes))


def corpus(spark, parts=4):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i * 7 % 90)), f"s{i % 5 if i % 3 else 0}") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)


def test_taken(spark):
    found = Mix(corpus(spark)).taken.collect()
    assert len(found) == 600 and all(r.size == r.id * 7 % 90 and 0 <= r.taken <= 2 * r.size for r in found)
    by = defaultdict(list)
    for r in found:
        by[r.source].append(r)
    for own in by.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3 * 64
    again = Mix(corpus(spark, 9)).taken.collect()
    assert sorted(map(tuple, ((r.id, r.taken) for r in again))) == sorted((r.id, r.taken) for r in found)


def test_shards_take_disjoint_blocks(spark):
    mix = Mix(corpus(spark), block_words=16, shard_blocks=100)
    drawn = mix.drawn.collect()
    assert len({(r.source_no, r.position) for r in drawn}) == len(drawn) == len({(r.source_no, r.block, r.epoch) for r in drawn})
    sizes = Counter(r.shard for r in drawn)
    assert len(sizes) > 5 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in drawn if r.shard == s) == list(range(n)) for s, n in sizes.items())
    quotas = {r.source_no: r.quota for r in mix.aims.collect()}
    assert Counter(r.source_no for r in drawn) == Counter({s: q for s, q in quotas.items() if q})


def test_texts_are_what_is_taken(spark):
    rows = samples.awkward(spark)
    found = mix_rows(rows).collect()
    assert mix_rows(rows).columns == rows.columns
    words = re.compile(WORD)
    taken = Counter()
    for r in found:
        taken[r.doc_id] += len(words.findall(r.text))
        assert r.n_chars == len(r.text)
    expected = Counter()
    for r in Mix(rows).taken.collect():
        expected[r.id] += r.taken
    assert taken == +expected
    whole = {i: words.findall(t or "") for i, t, _ in samples.TEXTS}
    for r in found:
        assert not Counter(words.findall(r.text)) - Counter(whole[r.doc_id] * 1)


def test_awkward(spark):
    found = Mix(samples.awkward(spark)).taken.collect()
    assert len(found) == len(samples.TEXTS)
    for i, t, s in samples.TEXTS:
        own = [r for r in found if r.id == i and r.source == s]
        assert any(r.size == len(re.findall(WORD, t or "")) for r in own)
    assert all(r.taken <= 2 * r.size for r in found)


def test_no_rows(spark):
    assert Mix(samples.none(spark)).taken.collect() == []
    assert mix_rows(samples.none(spark)).collect() == []
