"""Ids and texts are those of the sentencepiece library."""

import numpy as np
import public_tokenizers
import pytest
import samples
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from restock.llm import piece

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = st.sampled_from([" ", "  ", "▁", "a", "e", "th", "\n", "\t", "é", "日本", "😀", "\x00", "<s>", "ing", "==", "--", "0", ".", "ß"])


@pytest.fixture(scope="module")
def encoder():
    return piece.Encoder(PATH)


def same(encoder, text):
    data = encoder.encode([text])[0]
    expected = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    assert np.frombuffer(data, "<u4").tolist() == expected
    assert encoder.decode(data) == LIBRARY.decode(expected)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=40).map("".join), st.text(st.characters(exclude_categories=["Cs"]), max_size=60)))
def test_any_text(text):
    same(piece.encoder(PATH), text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=12))
def test_any_ids(ids):
    assert piece.encoder(PATH).decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", [t for _, t, _ in samples.TEXTS])
def test_awkward_texts(encoder, text):
    same(encoder, text)


def test_words_met_before_make_no_difference(encoder, monkeypatch):
    monkeypatch.setattr(piece, "KEPT", 5)
    monkeypatch.setattr(piece, "PAIRS", 7)
    for _ in range(2):
        for t in ("to be or not to be that is the question whether", "tis nobler in the mind to suffer"):
            same(encoder, t)


def test_a_known_word_is_cut_and_looked_up_without_being_gathered(encoder, monkeypatch):
    """Plain texts are cut at single spaces, others by the pattern; both find the same words, also long and new ones."""
    texts = ["to be", "to  be", " to be", "to be ", "to \n be", " ", "  ", "be " + "x" * 60, "▁to▁be", None, ""]
    cut = [encoder._cut((t or "").replace("▁", " ")) for t in texts]
    assert cut[:4] == [["to", "be"], ["to", " be"], [" to", "be"], ["to", "be", ""]] and cut[5:7] == [[" "], ["  "]] and cut[-2:] == [[], []]
    encoder.encode(texts)
    monkeypatch.setattr(encoder, "_path", None)
    known = [t for t in texts if t is None or "x" not in t]
    assert [np.frombuffer(d, "<u4").tolist() for d in encoder.encode(known)] == [LIBRARY.encode(t or "", add_bos=True, add_eos=True) for t in known]


def test_a_whole_text_without_words_apart(encoder, monkeypatch):
    monkeypatch.setattr(encoder, "by_word", False)
    same(encoder, "no  merge crosses \n the start   of a word " + "ab " * 500)


def test_columns(spark):
    rows = samples.awkward(spark)
    found = rows.withColumn("ids", piece.encode(F.col("text"), PATH)).withColumn("decoded", piece.decode(F.col("ids"), PATH))
    found = found.withColumn("both", piece.there_and_back(F.col("text"), PATH))
    for r in found.collect():
        assert (bytes(r.both.ids), r.both.decoded) == (bytes(r.ids), r.decoded)
        expected = LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == expected and r.decoded == LIBRARY.decode(expected)
    assert samples.none(spark).select(piece.encode(F.col("text"), PATH)).collect() == []
    assert spark.sql("select cast(null as binary) as ids").select(piece.decode(F.col("ids"), PATH)).first()[0] is None
