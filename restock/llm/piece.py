"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking over longest matches."""

from __future__ import annotations

import codecs
import functools
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN = " ⁇ "
SEGMENT = re.compile(" *[^ ]+| +")
APART = "\ud800"
KEPT = 200_000
KEPT_CHARS = 48
PAIRS = 200_000
NONE: dict[str, bool] = {}


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


class Encoder:
    """One model's tables.  Text is held with plain spaces where the model has its mark.

    The ids of a text are the one row of pieces in which every two neighbours, merged again from single characters,
    come out as these two.  They are found from the left: the longest piece that fits its neighbour is taken; where
    none does, the last piece is taken back and its place marked as failed, so that no place is tried in vain twice.
    A single character without a piece stands for its bytes.

    If no piece has a space after another character, merges never cross a word's start; words are then encoded one
    by one, and those met before are looked up, in two generations of bounded size.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.surface = [b""] * count
        self.marked: set[int] = set()
        self.silent = np.array([model.is_control(i) for i in range(count)], bool)
        self.ids: dict[str, int] = {}
        self.byte = [self.unknown] * 256
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_control(i):
                continue
            if model.is_unknown(i):
                self.surface[i] = UNKNOWN.encode()
            elif model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            else:
                self.surface[i] = piece.replace(MARK, " ").encode()
                if piece.startswith(MARK):
                    self.marked.add(i)
                if not model.is_unused(i):
                    self.ids[piece.replace(MARK, " ")] = i
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.by_word = not any(" " in p.lstrip(" ") for p in self.ids)
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            self.matches.add_word(p, (p, len(p) - 1))
        self.matches.make_automaton()
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), "") for p in self.ids}
        self.fits: dict[str, dict[str, bool]] = {}  # by the piece before, then by piece
        self.known = 0  # pairs in there
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merges(self, text: str) -> list[str]:
        """What greedy merging makes of the text: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _longest(self, text: str) -> list[str]:
        """The longest piece from each place on, or the character there."""
        found = list(text)
        for last, (piece, back) in self.matches.iter(text):
            found[last - back] = piece  # of one place, longer ones come later
        return found

    def _path(self, longest: list[str], at: int, end: int) -> list[str]:
        """The pieces from ``at`` to ``end``."""
        fits, shorter, path, begin, failed = self.fits, self.shorter, [], at, None
        before, piece, row = "", longest[at], fits.get("", NONE)
        while True:
            if piece:
                stop = at + len(piece)
                if failed is None or not failed[(stop - begin) >> 3] >> ((stop - begin) & 7) & 1:
                    ok = row.get(piece)
                    if ok is None:
                        ok = self._fit(before, piece)
                    if ok:
                        path.append(piece)
                        if stop == end:
                            return path
                        at, before, piece, row = stop, piece, longest[stop], fits.get(piece, NONE)
                        continue
                piece = shorter.get(piece) or (piece[0] if len(piece) > 1 else "")
                continue
            if not path:
                raise ValueError("no row of pieces is the merge of this text")
            if failed is None:
                failed = bytearray((end - begin >> 3) + 1)
            failed[(at - begin) >> 3] |= 1 << ((at - begin) & 7)
            last = path.pop()
            at -= len(last)
            before = path[-1] if path else ""
            row = fits.get(before, NONE)
            piece = shorter.get(last) or (last[0] if len(last) > 1 else "")

    def _fit(self, before: str, piece: str) -> bool:
        """Whether the two, merged again, come out as themselves; at a text's start, whether the piece does."""
        if self.known >= PAIRS:
            self.fits.clear()
            self.known = 0
        self.known += 1
        found = self.fits.setdefault(before, {})[piece] = self._merges(before + piece) == ([before, piece] if before else [piece])
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without its begin and end."""
        return self._path(self._longest(text), 0, len(text)) if text else []

    def _ids(self, path: list[str]) -> bytes:
        ids = list(map(self.ids.get, path))
        if None in ids:
            ids = [i for p, k in zip(path, ids, strict=True) for i in ([self.byte[b] for b in p.encode("utf-8", "replace")] if k is None else [k])]
        return array("I", ids).tobytes()

    @staticmethod
    def _cut(text: str) -> list[str]:
        """The words of a text, each without the space that it begins with once the text is marked."""
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return [w[1:] for w in SEGMENT.findall(" " + text)]
        return text.split(" ") if text else []

    def _joined(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of each text's words.  A word is looked up once, and again only in texts that have new ones.

        New ones are matched in one go, each after a character that no text has.
        """
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        own, old, late = self.young, self.old, {}
        parts = [list(map(own.get, words)) for words in cut]
        for words, found in zip(cut, parts, strict=True):
            late.update(dict.fromkeys(compress(words, map(not_, found))))
        for w in late:
            late[w] = old.get(w)
        new = [w for w, ids in late.items() if ids is None]
        longest, at = self._longest("".join([APART + " " + w for w in new])), 0
        for w in new:
            at, end = at + 1, at + len(w) + 2
            late[w] = self._ids(self._path(longest, at, end))
            at = end
        own.update((w, ids) for w, ids in late.items() if len(w) <= KEPT_CHARS)
        return [
            b"".join(found if all(found) else [ids or late[w] for w, ids in zip(words, found, strict=True)])
            for words, found in zip(cut, parts, strict=True)
        ]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """All ids of each text, begin and end included, as little-endian unsigned 32-bit integers."""
        begin, end = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        plain = [t.replace(MARK, " ") if t else "" for t in texts]
        if not self.by_word:
            return [begin + self._ids(self.pieces(" " + t if t else "")) + end for t in plain]
        return [begin + ids + end for ids in self._joined(list(map(self._cut, plain)))]

    def decode(self, data: bytes) -> str:
        """The text of ids: control ids are silent, runs of byte pieces are UTF-8, one mark at the start goes."""
        ids = np.frombuffer(data, "<u4")
        cuts = np.flatnonzero(self.silent[ids]).tolist()  # a control id ends a run
        ids = ids.tolist()
        runs = [r for a, b in zip([-1, *cuts], [*cuts, len(ids)], strict=True) if (r := ids[a + 1 : b])]
        text = "".join([b"".join(map(self.surface.__getitem__, r)).decode("utf-8", "each_byte") for r in runs])
        first = runs[0][0] if runs else None
        return text[1:] if first in self.marked else text


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(text: Column, path: str) -> Column:
    """All ids of each text as binary, little-endian unsigned 32-bit; null is encoded as empty: begin and end.

    ``path`` names the model file, which is there on every machine.  Texts are encoded whole, whatever their length.
    """

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for texts in batches:
            yield pd.Series(own.encode(texts), dtype=object)

    return ids(text)


def there_and_back(text: Column, path: str) -> Column:
    """A struct of the ids of each text, as ``encode`` gives, and the text ``decoded`` from these ids, in one worker."""

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for texts in batches:
            ids = own.encode(texts)
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(map(own.decode, ids), dtype=object)})

    return both(text)


def decode(ids: Column, path: str) -> Column:
    """The text of each binary of ids; null stays null, no ids are the empty text."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for data in batches:
            yield pd.Series([None if d is None else own.decode(d) for d in data], dtype=object)

    return texts(ids)
