"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, are trained from labels of documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.session import stage

SENTENCE = re.compile("[^.!?\n]+[.!?]*")
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7, 8)
FEATURES = 3000


def marks(word: str) -> list[str]:
    """A word in lower case and its beginnings."""
    return [word, *[word[:n] + "~" for n in STEMS if len(word) >= n]]


@dataclass
class Model:
    """Weights of words and beginnings, the bias of a sentence that has any, and the leak: what a text without has."""

    weights: dict[str, float]
    bias: float
    leak: float

    def __post_init__(self):
        self.words: dict[str, tuple[str, ...]] = {}

    def _known(self, word: str) -> tuple[str, ...]:
        found = self.words.get(word)
        if found is None:
            found = tuple(m for m in marks(word) if m in self.weights)
            if len(self.words) < 300_000:
                self.words[word] = found
        return found

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence with known marks, in order."""
        lower = text.lower()
        if not any(map(self._known, set(WORD.findall(lower)))):
            return []
        out = []
        same = len(lower) == len(text)
        for s in SENTENCE.finditer(text):
            part = lower[s.start() : s.end()] if same else s.group().lower()
            known = set()
            for w in WORD.findall(part):
                known.update(self._known(w))
            if known:
                z = self.bias + sum(self.weights[m] for m in sorted(known))
                out.append((s.start(), s.end(), float(1 / (1 + np.exp(-np.clip(z, -30, 30))))))
        return out

    def score(self, text: str) -> float:
        none = 1 - self.leak
        for _, _, p in self.sentences(text):
            none *= 1 - p
        return 1 - none


def screen(labelled: DataFrame, most: int = FEATURES) -> list[str]:
    """The marks that are found in toxic documents far more often than in others, by the likelihood ratio of their counts.

    ``labelled`` is (id, label, text); documents are counted, not occurrences.  At most ``most`` marks, as text order.
    """

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted({m for w in set(WORD.findall(t.lower())) for m in marks(w)}) for t in texts], dtype=object)

    total = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("t")).first()
    if not 0 < total.t < total.n:
        return []
    counted = labelled.select("label", F.explode(found(F.col("text"))).alias("mark")).groupBy("mark")
    counted = stage(counted.agg(F.count("*").cast("double").alias("n"), F.sum("label").cast("double").alias("t")), "toxicity-marks")
    share = F.lit(total.t / total.n)

    def part(seen, due):
        return F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)

    sure = 2 * (part(F.col("t"), F.col("n") * share) + part(F.col("n") - F.col("t"), F.col("n") * (1 - share)))
    lean = (F.col("t") / total.t) / F.greatest((F.col("n") - F.col("t")) / (total.n - total.t), F.lit(0.5 / (total.n - total.t)))
    least = 2 * np.log(max(2, counted.count()))  # so that among all marks hardly one passes by chance
    kept = counted.withColumn("sure", sure).filter((F.col("sure") >= least) & (lean >= 4)).orderBy(F.desc("sure"), "mark").limit(most)
    return sorted(r["mark"] for r in kept.select("mark").collect())


def train(labelled: DataFrame, most: int = FEATURES, rounds: int = 300, rate: float = 0.1, ridge: float = 1e-3) -> Model:
    """Weights fitted to (id, label, text) rows, whose number the caller bounds.

    Only sentences with screened marks come to the driver, as numbers of marks.  The likelihood of the documents' labels
    under the noisy-or is climbed by gradient steps, each sized by what its weight has seen so far.  The leak is the share of toxic
    documents among those without any mark.  Without toxic documents, or without others, every score is the leak.
    """
    labelled = stage(labelled, "toxicity-sample")
    names = screen(labelled, most)
    number = {m: i for i, m in enumerate(names)}
    shape = "id long, label int, cuts array<int>, marks array<int>"

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Model(dict.fromkeys(names, 0.0), 0.0, 0.0)
        for batch in batches:
            cuts, flat = [], []
            for text in batch["text"]:
                held = [sorted({number[m] for w in WORD.findall(text[a:b].lower()) for m in finder._known(w)}) for a, b, _ in finder.sentences(text)]
                cuts.append([len(h) for h in held])
                flat.append([m for h in held for m in h])
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "cuts": cuts, "marks": flat})

    found = labelled.select("id", "label", "text").mapInPandas(bags, shape).toPandas().sort_values("id", kind="stable")
    y = found["label"].to_numpy(dtype=float)
    sizes = [np.asarray(c, np.int64) for c in found["cuts"]]
    plain = np.array([len(c) == 0 for c in sizes], bool)
    leak = float((y[plain].sum() + 0.05) / (plain.sum() + 1))
    if not names:
        return Model({}, 0.0, float((y.sum() + 0.05) / (len(y) + 1)))
    document = np.repeat(np.arange(len(y)), [len(c) for c in sizes])
    sentence = np.repeat(np.arange(len(document)), np.concatenate(sizes))
    mark = np.concatenate([np.asarray(m, np.int64) for m in found["marks"]])
    w, bias = np.zeros(len(names)), -1.0
    seen_w, seen_b = np.full(len(names), 1e-8), 1e-8
    for _ in range(rounds):
        z = bias + np.bincount(sentence, w[mark], len(document))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.log1p(-leak) + np.bincount(document, np.log1p(-np.clip(p, 0, 1 - 1e-12)), len(y)))
        pull = np.where(y > 0, none / np.maximum(1 - none, 1e-12), -1.0)  # of each sentence's score, times its p
        slope = pull[document] * p
        g, gb = np.bincount(mark, slope[sentence], len(names)) - ridge * len(y) * w / max(1, len(names)), slope.sum()
        seen_w, seen_b = seen_w + g**2, seen_b + gb**2
        w, bias = w + rate * g / np.sqrt(seen_w) * 5, bias + rate * gb / np.sqrt(seen_b) * 5
    return Model({m: float(w[i]) for m, i in number.items()}, float(bias), leak)


def score(text: Column, model: Model) -> Column:
    """How likely each text is toxic; null counts as empty, and a text without known marks has the leak."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t or "") for t in texts], dtype=float)

    return rate(text)


def offending(text: Column, model: Model, least: float = 0.3) -> Column:
    """The sentences with a probability of ``least`` or more: an array of (start, end, probability), empty for null."""

    @F.pandas_udf("array<struct<start: int, end: int, probability: double>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"start": a, "end": b, "probability": p} for a, b, p in model.sentences(t or "") if p >= least] for t in texts], dtype=object)

    return find(text)
