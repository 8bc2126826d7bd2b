"""Every id is in one place, sequences have no gaps and no more than their room, and each piece goes where the sum is least."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import samples
from conftest import FOLDER
from tokenizers import Tokenizer

from restock.llm import sequences
from restock.llm.queries import CATALOGUE

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cuts():
    assert [sequences.cut(n, 4) for n in (1, 4, 5, 8, 9)] == [[(0, 1)], [(0, 4)], [(0, 1), (1, 4)], [(0, 4), (4, 4)], [(0, 1), (1, 4), (5, 4)]]


@pytest.mark.parametrize("sparing", [False, True])
def test_each_piece_goes_where_the_sum_of_squares_is_least(sparing):
    rng, room = np.random.default_rng(3), 20
    opened, left = sequences.Open(room), {}

    def total(rooms):
        return sum(n * n for r, n in Counter(rooms).items() if r)

    for length in rng.integers(1, room + 1, 400).tolist():
        fits = [total([r - length if k == name else r for k, r in left.items()]) for name, v in left.items() if v >= length]
        fresh = total([*left.values(), room - length])
        name, offset = opened.place(length, sparing)
        if name in left:
            assert left[name] >= length and offset == room - left[name]
        else:
            assert offset == 0 and (not fits if sparing else True)
        left[name] = left.get(name, room) - length
        assert total(left.values()) == (min(fits) if sparing and fits else min([*fits, fresh]))


def check(rows, room):
    """Sequences of (sequence, offset, length) are gapless; returns their number."""
    by = defaultdict(list)
    for name, offset, length in rows:
        by[name].append((offset, length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= room
    return len(by)


@pytest.mark.parametrize("kind", ["any", "half", "long", "ones", "pairs"])
def test_few_sequences(kind):
    rng = np.random.default_rng(4)
    lengths = {
        "any": rng.integers(1, 1024, 6000),
        "half": np.full(500, 512),
        "long": rng.integers(513, 1024, 500),
        "ones": np.ones(5000, np.int64),
        "pairs": np.concatenate([x := rng.integers(1, 1024, 2000), 1024 - x]),
    }[kind]
    sequence, offset = sequences.fill(lengths)
    made = check(zip(sequence, offset, lengths, strict=True), 1024)
    least = max(-(-lengths.sum() // 1024), (lengths > 512).sum())
    assert made <= {"any": 1.012, "half": 1, "long": 1, "ones": 1, "pairs": 1.012}[kind] * least + (kind == "any")


def pieces_of(rows, room):
    library, out = Tokenizer.from_file(PATH), Counter()
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % room or room
        cuts = [0, *range(first, len(ids), room), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out[i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    return out


@pytest.mark.parametrize(("room", "items"), [(64, 1 << 20), (1024, 7)])
def test_awkward_rows(spark, room, items):
    made = sequences.pieces(samples.awkward(spark).repartition(3), PATH, 2, room)
    found = sequences.pack(made, room, items).collect()
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces_of([(i, t) for i, t, _ in samples.TEXTS], room)
    check([(r.sequence_id, r.offset, r.length) for r in found], room)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = CATALOGUE["op13_sequence_packing"](spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces_of(rows, 1024)
    made = check([(r.sequence_id, r.offset, r.length) for r in found], 1024)
    assert made <= 1.03 * max(sum(r.length for r in found) / 1024, sum(r.length > 512 for r in found)) + 1


def test_no_rows(spark):
    assert sequences.pack(sequences.pieces(samples.none(spark), PATH, 2)).collect() == []
