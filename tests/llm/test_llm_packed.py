"""Packed ids come back as they went in, from any place, and are those of the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import samples
from tokenizers import Tokenizer, pre_tokenizers

from restock.llm import packed

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", range(1, 33))
def test_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, 2**bits, n, dtype=np.uint64).astype(np.uint32)
        data = packed.pack(ids, bits)
        assert len(data) == (n * bits + 7) // 8
        assert (packed.unpack(data, bits, n) == ids).all()


def test_widths():
    assert [packed.width(v) for v in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError, match="more than 3 bits"):
        packed.pack(np.array([8]), 3)


@pytest.mark.parametrize(("bits", "block_ids"), [(16, 64), (13, 50), (5, 1 << 16)])
def test_file(tmp_path, bits, block_ids, monkeypatch):
    monkeypatch.setattr(packed, "READ_IDS", 150)
    rng = np.random.default_rng(1)
    docs = [(None if i == 2 else i - 5, rng.integers(0, 2**bits, n).astype(np.uint32)) for i, n in enumerate([3, 0, 400, 1, 64, 50, 0, 1000, 2])]
    uri = f"file://{tmp_path}/a.ids"
    writer = packed.Writer(uri, bits, block_ids)
    for name, ids in docs:
        writer.add(name, ids)
    writer.close()
    reader = packed.Reader(uri)
    assert [(n, i.tolist()) for n, _, i in reader.documents()] == [(n, i.tolist()) for n, i in docs]
    everything = np.concatenate([i for _, i in docs])
    for start, stop in ((0, 0), (0, 1), (63, 65), (5, 1111), (1519, 1520), (0, 1520)):
        assert (reader.ids(start, stop) == everything[start:stop]).all()
    assert [p.name for p in tmp_path.iterdir()] == ["a.ids"]


def test_ids_are_the_library_s(monkeypatch):
    monkeypatch.setattr(packed, "KEPT", 4)
    library = Tokenizer.from_file(PATH)
    texts = [t or "" for _, t, _ in samples.TEXTS]
    texts += ["a b", " a b", "a b ", "a  b", "a\n b", "a \nb", "it's  we'll go 　on", "x\x1cy z", "12 345,6 !?", "A\r\n\r\nB c\td", "a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> <|endoftext|>y"]
    assert library.encode(texts[-3], add_special_tokens=False).ids == [64, 50256, 65]
    own = packed.Tokens(PATH)
    for _ in range(2):
        found = own.encode(texts)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    own = packed.Tokens(PATH, plain=True)
    library.encode_special_tokens = True
    assert [np.frombuffer(f, "<u4").tolist() for f in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pre_tokens_are_given_by_their_bytes():
    """The library need not cut and map again what is a pre-token already; every byte and character comes out the same."""
    own, library = packed.Tokens(PATH), Tokenizer.from_file(PATH)
    assert own.single.pre_tokenizer is None
    assert set(packed.BYTES) == set(pre_tokenizers.ByteLevel.alphabet()) and len(packed.BYTES) == 256
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    texts = ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x250, 64)] + [" été\x00\xad\xa0 ‘x’ … €", "x" * 500, " Straße 12.5", ""]
    assert all(packed.bytewise(t) == "".join(p for p, _ in cut.pre_tokenize_str(t)) for t in texts)
    found = [np.frombuffer(f, "<u4").tolist() for f in own.encode(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_written_and_read(spark, monkeypatch):
    rows = samples.awkward(spark).repartition(5)
    folder, files = packed.write(rows, PATH, 0, 50_257, block_ids=512)
    found = sorted(packed.read(folder, files).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    ordered = sorted(samples.TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    at = 0
    for r, (i, t, _) in zip(found, ordered, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_no_rows(spark):
    assert packed.read(*packed.write(samples.none(spark), PATH, 0, 50_257)).collect() == []
