"""Quality scores by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile("[^ \t-\r]+")
SENTENCE = re.compile("[.!?]+")
CLASSES = np.zeros(256, np.int64)  # of a byte: other, space, upper, lower, digit, stop, mark, beyond ASCII
CLASSES[[32, *range(9, 14)]] = 1
CLASSES[65:91] = 2
CLASSES[97:123] = 3
CLASSES[48:58] = 4
CLASSES[[33, 44, 46, 58, 59, 63]] = 5
CLASSES[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = np.where(
    np.isin([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)], [33, 44, 46, 58, 59, 63]), 5, 6
)
CLASSES[128:] = 7
CHUNK = 1 << 16


def statistics(text: str) -> list[float]:
    """Figures on a whole text: lengths, shares of character classes, words, repeats, lines, and how far it packs.  Empty: all 0."""
    data = text.encode("utf-8", "replace")
    n = len(data)
    if not n:
        return [0.0] * len(NAMES)
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(CLASSES, weights=octets, minlength=8) / n
    p = octets[octets > 0] / n
    words = WORD.findall(text)
    m = max(1, len(words))
    seen = Counter(words)
    often = [c for _, c in seen.most_common(3)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = [x for x in text.split("\n") if x.strip()]
    packer = zlib.compressobj(1)
    packed = sum(len(packer.compress(data[i : i + CHUNK])) for i in range(0, n, CHUNK)) + len(packer.flush())
    return [
        np.log1p(n), *kinds, float(-(p * np.log2(p)).sum()), float(octets.max() / n),
        np.log1p(len(words)), float(lengths.mean()), float(lengths.std()), float(lengths.max()),
        len(seen) / m, often[0] / m if often else 0.0, sum(often) / m,
        len(set(pairwise(words))) / m, sum(a == b for a, b in pairwise(words)) / m,
        sum(map(str.isupper, words)) / m, sum(map(str.istitle, words)) / m,
        sum(map(str.isalpha, words)) / m, sum(len(w) == 1 for w in words) / m,
        len(SENTENCE.findall(text)) / m,
        np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)),
        packed / n,
    ]


NAMES = (
    *("log_bytes other space upper lower digit stop mark beyond_ascii entropy top_byte".split()),
    *("log_words word_mean word_spread word_longest distinct top_word top_words pairs twice".split()),
    *("upper_words title_words alpha_words short_words stops log_lines distinct_lines words_a_line packed".split()),
)


def features(text: Column) -> Column:
    """The statistics of each text as an array; null counts as empty."""

    @F.pandas_udf("array<double>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t or "") for t in texts], dtype=object)

    return count(text)


@dataclass
class Forest:
    """Complete trees, one row each: the children of node i are 2i + 1 and 2i + 2.  A node without a split sends all left."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sums of leaf values: all rows go down all trees at once."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None]
        at = np.zeros((len(x), len(self.leaf)), np.int64)
        inner = self.feature.shape[1]
        for _ in range(int(np.log2(inner + 1))):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        return self.base + self.leaf[trees, at - inner].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 1.0) -> Forest:
    """Boosted trees for the logistic loss, level by level from histograms of gradients.

    ``least`` is the least sum of second derivatives in a leaf.  Without rows every score is 0.5; with rows of one label it is
    near that label.
    """
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if not len(y):
        return Forest(feature, threshold, leaf, 0.0)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)  # x <= edges[b] goes to bins up to b
    wide = x.shape[1]
    cells = binned + np.arange(wide) * bins
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            spot = ((node - first)[:, None] * wide * bins + cells).ravel()
            shape = (count, wide, bins)
            g = np.bincount(spot, np.repeat(slope, wide), count * wide * bins).reshape(shape).cumsum(2)
            h = np.bincount(spot, np.repeat(bend, wide), count * wide * bins).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for n in range(count):
                f, b = divmod(int(best[n]), bins)
                if gain[n, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + n], threshold[t, first + n] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        g, h = np.bincount(node - inner, slope, leaves), np.bincount(node - inner, bend, leaves)
        leaf[t] = rate * g / (h + ridge)
        margin += leaf[t][node - inner]
    return Forest(feature, threshold, leaf, base)


def train(labelled: DataFrame, **options) -> Forest:
    """Trees fitted to (id, label, text) rows, whose number the caller bounds; their statistics come to the driver."""
    found = labelled.select("id", "label", features(F.col("text")).alias("x")).toPandas()
    found["key"] = [tuple(v) for v in found["x"]]
    found = found.sort_values(["id", "key"], kind="stable")
    x = np.array(list(found["key"]), dtype=float).reshape(len(found), len(NAMES))
    return fit(x, found["label"].to_numpy(dtype=float), **options)


def score(text: Column, forest: Forest) -> Column:
    """How likely each text is of label 1; null counts as empty.  The text is the only input."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([statistics(t or "") for t in texts], dtype=float).reshape(len(texts), len(NAMES))
            yield pd.Series(forest.score(x), dtype=float)

    return rate(text)
