"""Spelling variants: words one edit apart, found through an index of grams of variable length."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.session import stage

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7  # code points of a word
FEWEST = 2  # occurrences of a word
TIMES = 10  # a form occurs so many times as often as its variant
DROPPED = 31  # of so many runs, one loses a code point
GRAM = 3  # the shortest gram, which needs no entry in the dictionary
BEFORE, AFTER = "^", "$"
ENTRIES = 1 << 16  # grams of one length in the dictionary, at most
SLOTS = 1 << 16  # of the table of gram counts
ENDS = 15  # characters of a word's beginning and end of which four bits are carried
HELD = 200_000  # grams counted in a worker before they are passed on


def occurrences(text: Column, id_column: Column, shortest: int = SHORTEST, dropped: int = DROPPED) -> Column:
    """The words of a text, with repeats, as an array.

    Words are maximal runs of letters, A-Z in lower case, of ``shortest`` code points at least.  A run whose crc32 of
    ``<id>:<run>`` is divisible by ``dropped`` loses the code point at crc32 modulo its length first.  A null text has no
    words; a null id counts as an empty one.
    """
    runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    own = F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"))

    def kept(run: Column) -> Column:
        crc = F.crc32(F.concat(own, run).cast("binary"))
        at = (crc % F.char_length(run)).cast("int")
        shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
        return F.when(crc % dropped == 0, shorter).otherwise(run)

    return F.filter(F.transform(runs, kept), lambda w: F.char_length(w) >= shortest)


def words(rows: DataFrame, text: str = "text", id_column: str = "doc_id", shortest: int = SHORTEST, fewest: int = FEWEST, dropped: int = DROPPED) -> DataFrame:
    """(word, n) of the words that occur ``fewest`` times or more in all rows; repeated rows count each time."""
    each = rows.select(F.explode(occurrences(F.col(text), F.col(id_column), shortest, dropped)).alias("word"))
    return stage(each.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest), "variants-words")


class Grams:
    """A dictionary of grams longer than ``GRAM``, pruned by frequency, and the grams of words by it.

    A gram of up to ``longest`` characters is in the dictionary if it makes up at least 1 / ``entries`` of all places of the
    words, so there are no more than ``entries`` of a length, and with a gram its beginnings are in it too.  A word, with
    ``pad`` marks on both sides, has at each place the longest gram that the dictionary has there, else the one of ``GRAM``
    characters; those that lie within an earlier one are left out.

    What one edit can affect: the gram at a place hangs on its own characters, on the one behind them if the dictionary has
    longer ones that begin so, and on earlier grams only where one of these may grow over it.  So an edit at character i
    affects grams from i or before that reach i, or end just there and may grow, and those behind i that end within a gram of
    the dictionary that begins at i or before.  All others are in the edited word too, moved by one place at most, and in the
    same order; the bound of a word is the most that are affected over all i.
    As ``longest`` is less than half of a padded word, at least one gram is left.
    """

    def __init__(self, entries: set[str], counts: np.ndarray, longest: int, pad: int):
        self.entries, self.counts, self.longest, self.pad = entries, counts, longest, pad
        self.inner = {g[i:j] for g in entries for i in range(1, len(g)) for j in range(i + GRAM, len(g) + 1)}
        self.longer = {g[:-1] for g in entries}

    @classmethod
    def fit(cls, found: DataFrame, shortest: int = SHORTEST, entries: int = ENTRIES) -> Grams:
        """Count the grams of all words (word).  What comes to the driver is bounded by ``entries`` and ``SLOTS``."""
        pad = GRAM - 1
        longest = (shortest + 2 * pad - 1) // 2
        lengths = range(GRAM, longest + 1)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: Counter[str] = Counter()

            def out() -> pd.DataFrame:
                return pd.DataFrame({"gram": list(held), "n": list(held.values())})

            for batch in batches:
                for word in batch["word"]:
                    s = BEFORE * pad + word + AFTER * pad
                    for q in lengths:
                        held.update([s[p : p + q] for p in range(len(s) - q + 1)])
                if len(held) > HELD:
                    yield out()
                    held.clear()
            if held:
                yield out()

        each = found.select("word").mapInPandas(count, "gram string, n long")
        grams = stage(each.groupBy("gram").agg(F.sum("n").alias("n")), "variants-grams")
        places = grams.filter(F.char_length("gram") == GRAM).agg(F.sum("n")).first()[0] or 0
        long = grams.filter((F.char_length("gram") > GRAM) & (F.col("n") * entries >= places)).select("gram")
        slots = grams.groupBy((F.crc32(F.col("gram").cast("binary")) % SLOTS).alias("slot")).agg(F.sum("n").alias("n"))
        counts = np.zeros(SLOTS, np.int64)
        for slot, n in slots.collect():
            counts[slot] = n
        return cls({r.gram for r in long.collect()}, counts, longest, pad)

    def split(self, word: str) -> tuple[list[tuple[int, str]], int]:
        """(place, gram) of the word's grams in order, and how many of them one edit can affect."""
        pad, entries, inner = self.pad, self.entries, self.inner
        s = BEFORE * pad + word + AFTER * pad
        kept, reached = [], 0
        change = [0] * (len(s) + 2)
        for p in range(len(s) - GRAM + 1):
            e = p + GRAM
            while e < len(s) and e - p < self.longest and s[p : e + 1] in entries:
                e += 1
            if e <= reached:
                continue
            reached = e
            kept.append((p, s[p:e]))
            first = p
            while first and s[first:e] in inner:
                first -= 1
            change[first] += 1
            change[e + (s[p:e] in self.longer)] -= 1
        now, most = sum(change[:pad]), 0
        for i in range(pad, pad + len(word)):
            now += change[i]
            most = max(most, now)
        return kept, most

    def chosen(self, word: str) -> list[tuple[int, str]]:
        """The rarest grams of a word, one more than an edit can affect.

        Of the grams that two words one edit apart share, the rarest is among these for both: in either word only affected
        ones can come before it.  So only these lists of the index need be merged.
        """
        kept, most = self.split(word)
        return sorted(kept, key=lambda g: (self.counts[zlib.crc32(g[1].encode()) % SLOTS], g[1], g[0]))[: most + 1]


def ends(word: str) -> tuple[int, int]:
    """Four bits of each of the first characters, and of the last ones from the end."""
    codes = [ord(c) & 15 for c in word[:ENDS]], [ord(c) & 15 for c in word[: -ENDS - 1 : -1]]
    return tuple(sum(c << 4 * i for i, c in enumerate(side)) for side in codes)


def _may_be_near() -> Column:
    """Whether a and b, not longer than b, may be one edit apart: what they share at both ends must cover the shorter one."""
    front, back = F.col("front_a").bitwiseXOR(F.col("front_b")), F.col("back_a").bitwiseXOR(F.col("back_b"))

    def same(x: Column) -> Column:
        return F.shiftright(F.bit_count(x.bitwiseAND(-x) - 1), 2)

    needed = F.char_length("b") - 1
    return (front == 0) | (back == 0) | (same(front) + same(back) >= needed)


def near(found: DataFrame, shortest: int = SHORTEST, entries: int = ENTRIES) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of different words (word, n) one edit apart, each once.

    Lists of the index are kept by gram, place and length of word.  A word of the same length has a shared gram at the same
    place, a longer one there or one place on.  What meets in a list is verified within the join, by its ends, then as a whole.
    """
    grams = Grams.fit(found, shortest, entries)

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, n, len(w), p, g, *ends(w)) for w, n in zip(batch["word"], batch["n"], strict=True) for p, g in grams.chosen(w)]
            yield pd.DataFrame(rows, columns=["word", "n", "length", "place", "gram", "front", "back"])

    index = stage(found.mapInPandas(lists, "word string, n long, length int, place int, gram string, front long, back long"), "variants-index")

    def key(longer: int, on: int) -> Column:
        return F.xxhash64("gram", F.col("length") + longer, F.col("place") + on)

    def named(side: str) -> list[Column]:
        return [F.col("word").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "front", "back")]]

    asked = index.select(*named("a"), F.explode(F.array(key(0, 0), key(1, 0), key(1, 1))).alias("key"))
    there = index.select(*named("b"), key(0, 0).alias("key"))
    once = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    met = asked.join(there, (asked["key"] == there["key"]) & _may_be_near() & once & (F.levenshtein("a", "b", 1) == 1))
    return stage(met.select("a", "n_a", "b", "n_b").distinct(), "variants-pairs")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last of the forms that follow one another.

    Each round follows twice as many forms as the one before; as a form occurs several times as often as its variant, there
    are few.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stage(step, "variants-roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def variants(found: DataFrame, times: int = TIMES, shortest: int = SHORTEST, entries: int = ENTRIES) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n.

    The words all have ``shortest`` code points or more, and each is there once.  n_near counts the words one edit apart (one
    code point inserted, deleted or replaced).  The form is the one of these with the largest n, of equals the first by code
    points, if it occurs at least ``times`` as often; else form and form_n are null.  The root is the last of the forms that
    follow from the word on, or the word itself.  No words give no rows.
    """
    pairs = near(found, shortest, entries)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")),
    )
    each = pairs.select(F.inline(both))
    best = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    known = found.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("near"), (-F.col("best.m")).alias("m"))
    is_form = F.col("m") >= F.col("n") * times
    known = stage(known.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("m")).alias("form_n")), "variants-forms")
    last = roots(known.filter("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
