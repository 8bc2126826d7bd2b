"""Unigram token counts, with forward scores shared along the trie of the pre-tokens."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
WORD = re.compile("[^ \t-\r]+")
KEPT = 400_000
KEPT_CHARS = 48
BATCH_CHARS = 4_000_000
SHIFT = 32


def costs(path: str) -> tuple[dict[str, int], int]:
    """Thousandths of -log probability of each text piece of a model, and of a byte piece.

    The file's pieces are ordered by rank; their probability is taken from Zipf's law, as 1 / (rank H) with H the
    harmonic sum, and a byte piece has that of the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = math.log(sum(1 / r for r in range(1, len(text) + 1)))
    found = {model.id_to_piece(i): round(1000 * (math.log(r) + norm)) for r, i in enumerate(text, 1)}
    return found, round(1000 * (math.log(max(1, len(text))) + norm))


class Counter:
    """Best scores of pre-tokens: the least sum of costs, and of equal sums the fewest tokens.

    A score holds cost and count in one integer, so that sums and minima of scores are those of the pairs.  The nodes of a
    trie of pre-tokens each have the best score of their prefix and the pieces that are open there; both follow from the
    parent's.  In sorted order the pre-tokens come as a depth-first walk of the trie, so only the nodes of one path
    are held, each is scored once however many pre-tokens share it, and the score of a whole pre-token is kept.
    """

    def __init__(self, path: str):
        pieces, byte = costs(path)
        self.byte = (byte << SHIFT) + 1
        self.root: dict = {}
        for piece, cost in pieces.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (cost << SHIFT) + 1
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def scores(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """(pre-token, score) of distinct pre-tokens, in sorted order."""
        root, byte = self.root, self.byte
        path: list[tuple[int, list]] = [(0, [])]  # by depth: best score, open (node of the pieces' trie, score before it)
        before = ""
        for word in sorted(words):
            depth = 0
            for a, b in zip(word, before):  # noqa: B905
                if a != b:
                    break
                depth += 1
            del path[depth + 1 :]
            for c in word[depth:]:
                best, open_ = path[-1]
                going, least = [], None
                for node, base in (*open_, (root, best)):
                    node = node.get(c)
                    if node is not None:
                        going.append((node, base))
                        own = node.get("")
                        if own is not None and (least is None or base + own < least):
                            least = base + own
                if c not in root or "" not in root[c]:  # a character without a piece is spelt in bytes
                    spelt = best + byte * len(c.encode("utf-8", "replace"))
                    least = spelt if least is None else min(least, spelt)
                path.append((least, going))
            before = word
            yield word, path[-1][0]

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(words, score) of each text."""
        words = [WORD.findall(t) for t in texts]
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        own, old = self.young, self.old
        new = set(chain.from_iterable(words)).difference(own)
        for w in [w for w in new if w in old]:
            own[w] = old[w]
            new.remove(w)
        once = {}
        for marked, score in self.scores(MARK + w for w in new):
            (own if len(marked) <= KEPT_CHARS else once)[marked[1:]] = score
        if not once:
            return [(len(ws), sum(map(own.__getitem__, ws))) for ws in words]
        return [(len(ws), sum(own[w] if w in own else once[w] for w in ws)) for ws in words]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counts(text: Column, path: str) -> Column:
    """A struct of n_words, n_tokens and log_probability of each text under the unigram model of ``path``.

    Pre-tokens are the words, each with the mark before it.  Null and empty texts have none: 0, 0 and 0.0.  Texts are
    counted whole; no rows are moved, and nothing depends on other rows.
    """

    @F.pandas_udf("n_words long, n_tokens long, log_probability double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = counter(path)
        for texts in batches:
            out, held, size = [], [], 0
            for t in texts:
                held.append(t or "")
                size += len(held[-1])
                if size >= BATCH_CHARS:
                    out += own.count(held)
                    held, size = [], 0
            out += own.count(held)
            yield pd.DataFrame(
                {
                    "n_words": [n for n, _ in out],
                    "n_tokens": [s & ((1 << SHIFT) - 1) for _, s in out],
                    "log_probability": [-(s >> SHIFT) / 1000 for _, s in out],
                }
            )

    return count(text)
