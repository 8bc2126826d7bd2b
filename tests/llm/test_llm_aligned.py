"""Groups, links and counts are those of walking over both libraries' tokens one by one."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import samples
import sentencepiece
from conftest import FOLDER
from tokenizers import Tokenizer

from restock.llm import aligned
from restock.llm.queries import CATALOGUE

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["naïve café ▁ mark", "a▁", "日本語のテキスト", "😀😀 émoji 👩‍👩‍👧", "<s> </s> <unk> <0x41> <|endoftext|>", "x" * 3000, "    deep   \n\n\tindent ", "ab" * 700 + "é" * 50, "\x00\x01", " ", "１２３ ﬁ Ａ"]


bytewise, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
bytewise.encode_special_tokens = True
A_BYTES, B_BYTES = aligned.byte_table(bytewise.get_vocab()), aligned.piece_table(pieces)


def groups_of(text):
    """[(A ids, B ids, start, stop)] of one text."""
    if not text:
        return []
    whole, tables = f" {text}".encode(), (A_BYTES, B_BYTES)
    sides = [bytewise.encode(f" {text}", add_special_tokens=False).ids, pieces.encode(text)]
    if any(b"".join(t[i] for i in ids) != whole for t, ids in zip(tables, sides, strict=True)):
        return []
    out, at, ends = [], [0, 0], [0, 0]
    now, start = ([], []), 0
    while at[0] < len(sides[0]) or at[1] < len(sides[1]):
        side = 0 if ends[0] <= ends[1] and at[0] < len(sides[0]) else 1
        i = sides[side][at[side]]
        now[side].append(i)
        at[side] += 1
        ends[side] += len(tables[side][i])
        if ends[0] == ends[1]:
            out.append((*now, start, ends[0]))
            now, start = ([], []), ends[0]
    assert ends == [len(whole)] * 2 and now == ([], [])
    return out


def brute(texts):
    rows, docs = [], Counter()
    for i, t in texts:
        found = groups_of(t)
        links = Counter((a, b) for g in found for a in g[0] for b in g[1])
        docs.update(links.keys())
        rows.append((i, found, links))
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    out = Counter()
    for i, found, links in rows:
        shown = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in found)
        best = sum(n for p, n in links.items() if docs[p] == top[p[0]])
        sizes = [sum(len(g[s]) for g in found) for s in (0, 1)]
        sha = hashlib.sha256(shown.encode()).hexdigest() if found else ""
        out[i, *sizes, len(found), sum(links.values()), best, sum(n * docs[p] for p, n in links.items()), sha] += 1
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize(("chunk", "links", "many"), [(aligned.CHUNK_CHARS, aligned.LINKS, aligned.MANY), (300, 50, 3)])
def test_awkward_texts(spark, monkeypatch, chunk, links, many):
    texts = [(i, t, None) for i, t, _ in samples.TEXTS] + [(100 + i, t, "odd") for i, t in enumerate(ODD)]
    own = aligned.Aligner(*PATHS)
    monkeypatch.setattr(aligned, "LINKS", links)
    monkeypatch.setattr(aligned, "MANY", many)
    for _, t, _ in texts:
        expected = Counter((a, b) for g in groups_of(t) for a in g[0] for b in g[1])
        found = aligned.counted(*own.align([None, t, ""]))
        assert set(found["doc"]) <= {1}
        assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(found["pair"], found["times"], strict=True)} == expected
    monkeypatch.setattr(aligned, "CHUNK_CHARS", chunk)
    cuts = aligned._cuts([t for _, t, _ in texts])
    assert [i for i, _ in cuts] == [0, *(j for _, j in cuts)][:-1] and cuts[-1][1] == len(texts)
    if chunk == 300:
        return
    found = aligned.align(samples.awkward(spark, texts).repartition(3), *PATHS)
    assert Counter((r.id, *[r[n] for n in NAMES]) for r in found.collect()) == brute([(i, t) for i, t, _ in texts])


def test_groups_with_their_places(spark):
    texts = [(i, t, None) for i, t in enumerate([*ODD, None, "", "Two words, and some more."])]
    found = aligned.groups(samples.awkward(spark, texts), *PATHS).collect()
    expected = Counter((i, str(g)) for i, t, _ in texts for g in groups_of(t))
    assert Counter((r.id, str((r.a_ids, r.b_ids, r.start, r.stop))) for r in found) == expected


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = CATALOGUE["op12_token_alignment"](spark, FOLDER).collect()
    assert Counter((r.doc_id, *[r[n] for n in NAMES]) for r in found) == brute(rows)


def test_no_rows(spark):
    assert aligned.align(samples.none(spark), *PATHS).collect() == []
    assert aligned.groups(samples.none(spark), *PATHS).collect() == []
