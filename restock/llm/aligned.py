"""Cross-tokenizer alignment: tokens of a byte-level and of a piece tokenizer over the same bytes."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.packed import tokens
from restock.llm.storing import store
from restock.session import stage

MARK = "▁"
CHUNK_CHARS = 1_000_000  # of the texts that are aligned in one go, but for a longer text, which is on its own
LINKS = 1 << 21  # held in one go
MANY = 1 << 12  # links of a group from which on its repeated ids are counted before they are paired


def byte_table(entries: dict[str, int]) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary, whose letters stand for one byte each."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = bytes(map(letters.__getitem__, entry)) if set(entry) <= letters.keys() else entry.encode()
    return out


def piece_table(model) -> list[bytes]:
    """The bytes of each piece, with a space for the mark, or the one byte that a byte piece stands for."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]


def _numbered(ids: int, marks: str) -> np.ndarray:
    """Every id as text with each of the marks behind it: mark by mark, then id by id."""
    return np.array([f"{i}{m}" for m in marks for i in range(ids)], dtype=object)


class Aligner:
    """Both tokenizers; A is the byte-level one, which sees a space before the text, as B does by itself."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.bytewise = tokens(byte_path, plain=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.tables = byte_table(self.bytewise.library.get_vocab(with_added_tokens=True)), piece_table(self.pieces)
        self.sizes = tuple(np.array(list(map(len, t)), np.int64) for t in self.tables)
        self.places = tuple(np.cumsum(n) - n for n in self.sizes)  # of each token in all tokens' bytes in a row
        self.bytes = tuple(np.frombuffer(b"".join(t), np.uint8) for t in self.tables)
        self.shown = tuple(_numbered(len(t), m) for t, m in zip(self.tables, (",|", ",;"), strict=True))

    def _whole(self, ids: list[np.ndarray], side: int, texts: list[bytes]) -> list[bool]:
        """Whether the bytes of the ids are those of the text, for each text."""
        flat = np.concatenate([np.zeros(0, np.int64), *ids])
        sizes = self.sizes[side][flat]
        at = np.arange(sizes.sum()) + np.repeat(self.places[side][flat] - (np.cumsum(sizes) - sizes), sizes)
        found = memoryview(self.bytes[side][at])
        stops = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(i) for i in ids]))].tolist()
        return [found[i:j] == t for i, j, t in zip(stops, stops[1:], texts, strict=False)]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both sides; none for a null or empty text and for one whose bytes either side does not give back."""
        one = [np.frombuffer(d, "<u4").astype(np.int64) for d in self.bytewise.encode([f" {t}" if t else "" for t in texts])]
        two = [np.array(i, np.int64) for i in self.pieces.encode([t or "" for t in texts], num_threads=1)]
        spaced, none = [f" {t}".encode("utf-8", "replace") if t else b"" for t in texts], np.zeros(0, np.int64)
        for d, sides in enumerate(zip(self._whole(one, 0, spaced), self._whole(two, 1, spaced), strict=True)):
            if not (texts[d] and all(sides)):
                one[d] = two[d] = none
        return one, two

    def _frame(self, ids: list[np.ndarray], side: int) -> pd.DataFrame:
        """doc, id, start and end of each token; places count on from text to text."""
        whole = np.concatenate([np.zeros(0, np.int64), *ids])
        end = np.cumsum(self.sizes[side][whole])
        doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
        return pd.DataFrame({"doc": doc, "id": whole, "start": end - self.sizes[side][whole], "end": end})

    def align(self, texts: list[str | None]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The tokens (doc, id, start, end, group) of both sides; tokens of one number in ``group`` cover the same bytes.

        The start of each token finds the other side's token that covers it; both directions together are the overlaps,
        and where the two ends of an overlap are equal, a group ends.
        """
        a, b = (self._frame(ids, side) for side, ids in enumerate(self.tokens(texts)))
        if a.empty:
            return a.assign(group=a["id"]), b.assign(group=b["id"])
        one, two = (f[["doc", "start", "end"]].assign(at=np.arange(len(f))) for f in (a, b))
        there = pd.merge_asof(one, two, on="start", by="doc", suffixes=("_a", "_b"))
        back = pd.merge_asof(two, one, on="start", by="doc", suffixes=("_b", "_a"))
        for frame, at in ((a, "at_a"), (b, "at_b")):
            last = np.zeros(len(frame), np.int64)
            for overlaps in (there, back):
                equal = overlaps["end_a"].to_numpy() == overlaps["end_b"].to_numpy()
                last[overlaps[at].to_numpy()[equal].astype(np.int64)] = 1
            frame["group"] = np.cumsum(last) - last
        return a, b

    def shown_groups(self, a: pd.DataFrame, b: pd.DataFrame, docs: int) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
        if a.empty:
            return [""] * docs
        ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
        ends_a, ends_b = np.append(np.diff(ga) > 0, True), np.append(np.diff(gb) > 0, True)
        before_a, before_b = np.append(0, np.cumsum(np.bincount(ga))), np.append(0, np.cumsum(np.bincount(gb)))
        row = np.empty(len(a) + len(b), dtype=object)
        row[np.arange(len(a)) + before_b[ga]] = self.shown[0][a["id"].to_numpy() + ends_a * len(self.tables[0])]
        row[np.arange(len(b)) + before_a[gb + 1]] = self.shown[1][b["id"].to_numpy() + ends_b * len(self.tables[1])]
        stops = np.append(0, np.cumsum(np.bincount(a["doc"], minlength=docs) + np.bincount(b["doc"], minlength=docs))).tolist()
        row = row.tolist()
        return ["".join(row[i:j])[:-1] for i, j in zip(stops, stops[1:], strict=False)]


@functools.lru_cache(maxsize=1)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def linked(a: pd.DataFrame, b: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """(doc, pair, times) of the tokens linked, some groups at a time; pair is the id of A times 2^32 plus the id of B.

    All tokens of a group are linked.  In a group of many links, repeated ids are counted first, so that what is made is no
    more than the pairs of different ids.
    """
    if a.empty:
        return
    ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
    na, nb = np.bincount(ga), np.bincount(gb)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    ids_a, ids_b, doc = a["id"].to_numpy(), b["id"].to_numpy(), a["doc"].to_numpy()
    made = na * nb
    for g in np.flatnonzero(made >= MANY):
        (one, times), (two, more) = (np.unique(i[s : s + n], return_counts=True) for i, s, n in ((ids_a, first_a[g], na[g]), (ids_b, first_b[g], nb[g])))
        step = max(1, LINKS // len(two))
        for i in range(0, len(one), step):
            pairs, weight = (one[i : i + step, None] << 32) + two, times[i : i + step, None] * more
            yield pd.DataFrame({"doc": doc[first_a[g]], "pair": pairs.ravel(), "times": weight.ravel()})
    few = np.flatnonzero(made < MANY)
    for part in np.split(few, np.flatnonzero(np.diff(np.cumsum(made[few]) // LINKS)) + 1):
        n = made[part]
        g = np.repeat(part, n)
        at = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
        x, y = first_a[g] + at // nb[g], first_b[g] + at % nb[g]
        yield pd.DataFrame({"doc": doc[x], "pair": (ids_a[x] << 32) + ids_b[y], "times": 1})


def counted(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(doc, pair, times) once per text and pair, in this order."""
    out = [part.groupby(["doc", "pair"], as_index=False, sort=False)["times"].sum() for part in linked(a, b)]
    if not out:
        return pd.DataFrame({"doc": [], "pair": [], "times": []}, dtype="int64")
    return pd.concat(out).groupby(["doc", "pair"], as_index=False)["times"].sum()


def _cuts(texts: list[str | None]) -> list[tuple[int, int]]:
    """Where to cut a batch, so that a part has no more than ``CHUNK_CHARS`` characters or is one text."""
    cuts, held = [0], 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > CHUNK_CHARS:
            cuts.append(i)
            held = 0
        held += len(t or "")
    return list(zip(cuts, [*cuts[1:], len(texts)], strict=True)) if texts else []


def groups(rows: DataFrame, byte_path: str, piece_path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The groups of each text: id, start and stop (bytes of the text with a space before it), a_ids and b_ids.

    Texts that are null or empty, or that either side does not give back, have none; repeated rows have theirs each.
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = aligner(byte_path, piece_path)
        for batch in batches:
            texts, names = batch["text"].tolist(), batch["id"].to_numpy(object)
            for i, j in _cuts(texts):
                a, b = own.align(texts[i:j])
                if a.empty:
                    continue
                ids_b = b.groupby("group")["id"].agg(list)
                met = a.groupby("group").agg(doc=("doc", "first"), start=("start", "min"), stop=("end", "max"), a_ids=("id", list))
                base = met.groupby("doc")["start"].transform("min")
                yield pd.DataFrame(
                    {"id": names[i:j][met["doc"]], "start": met["start"] - base, "stop": met["stop"] - base, "a_ids": met["a_ids"], "b_ids": ids_b}
                )

    flat = rows.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    return flat.mapInPandas(make, "id string, start long, stop long, a_ids array<int>, b_ids array<int>").withColumn("id", F.col("id").cast(rows.schema[id_column].dataType))


CHUNKED = "id string, chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs array<long>, held array<long>"


def _chunked(rows: DataFrame, byte_path: str, piece_path: str, text: str, id_column: str) -> DataFrame:
    """Per row its numbers, and its pairs as places in the sorted pairs of its chunk; these are with a chunk's first row."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, number = aligner(byte_path, piece_path), numbers(TaskContext.get().partitionId() << 40)
        for batch in batches:
            texts = batch["text"].tolist()
            for i, j in _cuts(texts):
                a, b = own.align(texts[i:j])
                docs, links = j - i, counted(a, b)
                pairs, place = np.unique(links["pair"].to_numpy(), return_inverse=True)
                stops = np.searchsorted(links["doc"], np.arange(docs + 1))
                place, times = place.astype("<u4"), links["times"].to_numpy("<u4")
                ends = np.append(np.diff(a["group"]) > 0, True) if len(a) else np.zeros(0, bool)
                shown = own.shown_groups(a, b, docs)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].iloc[i:j].to_numpy(object),
                        "chunk": next(number),
                        "n_a": np.bincount(a["doc"], minlength=docs),
                        "n_b": np.bincount(b["doc"], minlength=docs),
                        "n_groups": np.bincount(a["doc"][ends], minlength=docs),
                        "n_links": np.bincount(links["doc"], links["times"], docs).astype(np.int64),
                        "groups_sha256": [s and hashlib.sha256(s.encode()).hexdigest() for s in shown],
                        "places": [place[x:y].tobytes() for x, y in zip(stops, stops[1:], strict=False)],
                        "times": [times[x:y].tobytes() for x, y in zip(stops, stops[1:], strict=False)],
                        "pairs": [pairs] + [None] * (docs - 1),
                        "held": [np.bincount(place, minlength=len(pairs))] + [None] * (docs - 1),
                    }
                )

    flat = rows.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    return store(flat.mapInPandas(make, CHUNKED), "aligned-texts")


def counts(chunked: DataFrame) -> DataFrame:
    """(pair, count, best) over all texts: in how many the pair is linked, and whether no pair of the same id of A is in more."""
    each = chunked.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("held").alias("held"))))
    found = stage(each.groupBy("pair").agg(F.sum("held").alias("count")), "aligned-pairs").withColumn("a", F.shiftright("pair", 32))
    top = found.groupBy("a").agg(F.max("count").alias("top"))
    return found.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align(rows: DataFrame, byte_path: str, piece_path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_links counts the pairs of tokens in one group, n_best those of them whose count (of texts that link the two ids) is
    the highest of the id of A, count_sum sums the counts.  Texts that are null or empty, or whose bytes either
    side does not give back, have zeros and an empty groups_sha256.  A null id stays null; repeated rows count each as a
    text; other columns are not looked at; no rows give none.

    Counts are looked up once per chunk of texts and pair, not per text: a pair that all texts have comes once from each
    chunk, and a chunk's texts meet its counts in one group, whose size is bounded by ``CHUNK_CHARS`` or by its one text.
    """
    chunked = _chunked(rows, byte_path, piece_path, text, id_column)
    known = chunked.select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair")).join(counts(chunked), "pair")

    def add(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("pair")
        each, best = found["count"].to_numpy(np.int64), found["best"].to_numpy(np.int64)
        sums = []
        for places, times in zip(texts["places"], texts["times"], strict=True):
            at, n = np.frombuffer(places, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
            sums.append((int(n @ best[at]), int(n @ each[at])))
        texts["n_best"], texts["count_sum"] = zip(*sums, strict=True) if sums else ([], [])
        return texts.drop(columns=["chunk", "places", "times"])

    kept = chunked.drop("pairs", "held").groupBy("chunk")
    out = "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = kept.cogroup(known.groupBy("of")).applyInPandas(add, out)
    return done.withColumn("id", F.col("id").cast(rows.schema[id_column].dataType))
