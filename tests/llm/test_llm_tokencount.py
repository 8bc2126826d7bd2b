"""Counts are those of the best split of each word, found anew for each."""

import random
import re

import public_tokenizers
import pytest
import samples
from pyspark.sql import functions as F

from restock.llm import tokencount

PATH = public_tokenizers.path("piece_bpe_32k.model")
COSTS, BYTE = tokencount.costs(PATH)


def best(word):
    """(cost, tokens) of the cheapest split; of equals the one with fewest tokens."""
    table = [(0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(table[s][0] + COSTS[word[s:end]], table[s][1] + 1) for s in range(max(0, end - 20), end) if word[s:end] in COSTS]
        if word[end - 1] not in COSTS:
            n = len(word[end - 1].encode())
            ways.append((table[end - 1][0] + n * BYTE, table[end - 1][1] + n))
        table.append(min(ways))
    return table[-1]


def brute(text):
    words = [best("▁" + w) for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    return len(words), sum(n for _, n in words), -sum(c for c, _ in words) / 1000


def test_awkward(spark):
    rows = samples.awkward(spark)
    found = rows.withColumn("c", tokencount.counts(F.col("text"), PATH)).collect()
    for r in found:
        n, t, p = brute(r.text)
        assert (r.c.n_words, r.c.n_tokens) == (n, t) and r.c.log_probability == pytest.approx(p)
    assert samples.none(spark).select(tokencount.counts(F.col("text"), PATH)).collect() == []


def test_shared_beginnings(monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT", 10)
    rng = random.Random(2)
    own = tokencount.Counter(PATH)
    texts = [" ".join(rng.choice(["un", "in", "re", "日"]) + rng.choice(["der", "t", "ter", "\x00", ""]) + rng.choice(["stand", "s", "😀"]) for _ in range(9)) for _ in range(60)]
    for _ in range(2):
        for t, (n, score) in zip(texts, own.count(texts), strict=True):
            assert (n, score & (2**32 - 1), score >> 32) == (brute(t)[0], brute(t)[1], round(-1000 * brute(t)[2]))
