"""Words, near words, forms and roots are those of comparing all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import samples
from conftest import FOLDER

from restock.llm import variants
from restock.llm.queries import CATALOGUE


def brute_words(rows, shortest=7, fewest=2):
    counts: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(counts):
    by_key = defaultdict(set)  # words that are alike but for one left-out place meet under what is left
    for w in counts:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_key[k].add(w)
    near = defaultdict(set)
    for met in by_key.values():
        for a in met:
            near[a] |= {b for b in met if one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def spelt(rng, w, letters):
    at, c = rng.randrange(len(w) + 1), rng.choice(letters)
    return rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])


def some_words(seed, letters, count):
    rng = random.Random(seed)
    out = set()
    while len(out) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 16)))
        out |= {w, *(spelt(rng, w, letters) for _ in range(3))}
    return {w: rng.choice([2, 3, 20, 30, 300, 3000]) for w in sorted(out) if len(w) >= 7}


@pytest.mark.parametrize(("letters", "entries"), [("ab", 40), ("abcdé", 1), ("abcdé", variants.ENTRIES), ("abcdefghijklmnopqrstuvwxyzß÷", 40)])
def test_near_forms_and_roots(spark, letters, entries):
    counts = some_words(len(letters) + entries, letters, 400)
    counts |= {"a" * 7: 5, "a" * 8: 50, "a" * 9: 500, "a" * 400: 2, "a" * 401: 20, "b" + "a" * 400: 7}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(variants.variants(df, entries=entries)) == brute(counts)


@pytest.mark.parametrize("entries", [3, 60])
def test_an_edit_affects_no_more_grams_than_the_bound(spark, entries):
    rng = random.Random(entries)
    letters = "abc"
    counts = some_words(5, letters, 300)
    grams = variants.Grams.fit(spark.createDataFrame([(w,) for w in counts], "word string"), entries=entries)
    assert all(len(g) <= 4 or g[:-1] in grams.entries for g in grams.entries)
    assert all(sum(len(g) == q for g in grams.entries) <= entries for q in range(4, grams.longest + 1))
    for w in counts:
        kept, most = grams.split(w)
        assert most < len(kept)
        for _ in range(20):
            other = spelt(rng, w, letters)
            if len(other) < 7 or other == w:
                continue
            theirs, bound = grams.split(other)
            moved = len(other) - len(w)
            at, matched = 0, 0  # shared grams in order, each unmoved or moved by the edit
            for p, g in kept:
                here = next((i for i in range(at, len(theirs)) if theirs[i][1] == g and theirs[i][0] - p in (0, moved)), None)
                if here is not None:
                    at, matched = here + 1, matched + 1
            assert matched >= len(kept) - most and matched >= len(theirs) - bound
            assert {g for _, g in grams.chosen(w)} & {g for _, g in grams.chosen(other)}


def test_words_of_awkward_rows(spark):
    rows = samples.awkward(spark)
    expected = brute_words([(i, t) for i, t, _ in samples.TEXTS])
    assert {(r.word, r.n) for r in variants.words(rows).collect()} == set(expected.items())
    texts = [(i, f"Straße STRASSEN ÉCOLE-École éCOLES naïveté×x {'Wörterbuch ' * (i % 5)} abcdefg aBcDeFgH {'z' * 3000}", None) for i in range(200)]
    texts += [(None, "withoutid Withoutid", None)]
    expected = brute_words([(i, t) for i, t, _ in texts])
    found = variants.words(samples.awkward(spark, texts))
    assert {(r.word, r.n) for r in found.collect()} == set(expected.items())
    assert rows_of(variants.variants(found)) == brute(expected)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(CATALOGUE["op11_spelling_variants"](spark, FOLDER)) == brute(brute_words(rows))


def test_no_rows(spark):
    assert variants.variants(variants.words(samples.none(spark))).collect() == []
