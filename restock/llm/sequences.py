"""Packing token ids into sequences of one length by sums of squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.packed import BATCH_CHARS, tokens
from restock.session import stage

ROOM = 1024
ITEMS = 1 << 17  # pieces that one task packs, about
NEVER = 1 << 60


def cut(count: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids; all but the first have ``room``."""
    first = (count - 1) % room + 1 if count else 0
    return [(0, first), *((s, room) for s in range(first, count, room))]


class Open:
    """Sequences being filled, by the room they have left."""

    def __init__(self, room: int):
        self.room, self.made = room, 0
        self.count = np.zeros(room + 1, np.int64)  # of open sequences by room left; full ones do not count
        self.names: list[list[int]] = [[] for _ in range(room + 1)]

    def place(self, length: int, sparing: bool = False) -> tuple[int, int]:
        """Put a piece where the squared counts of open sequences per room left sum up to the least: (sequence, offset).

        Of equals, the least room left; a new sequence only if it gives a smaller sum, or, ``sparing``, if none has room.
        """
        now, then = self.count[length:], self.count[: self.room - length + 1]
        change = 2 * (then - now) + 2
        change[0] -= 1  # a full one leaves the counts and is in no other
        change[now == 0] = NEVER
        best = int(change.argmin())
        opened = 2 * int(self.count[self.room - length]) + 1 if length < self.room else 0
        if change[best] < (NEVER if sparing else min(opened, NEVER)):
            left = length + best
            name = self.names[left].pop()
            self.count[left] -= 1
        else:
            left, name = self.room, self.made
            self.made += 1
        if left > length:
            self.names[left - length].append(name)
            self.count[left - length] += 1
        return name, self.room - left


def _placed(lengths: np.ndarray, order: np.ndarray, room: int, sparing: bool) -> tuple[Open, np.ndarray]:
    """The sequences made, and (sequence, offset) of the pieces in the order given."""
    opened = Open(room)
    places = [opened.place(n, sparing) for n in lengths[order].tolist()]
    return opened, np.array(places, np.int64).reshape(-1, 2)


def fill(lengths: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, each put where the sum of squares is least, in the better of two orders.

    The one takes the longest first and opens a sequence only where none has room.  The other takes pieces of more than half
    of the room first, the longest first, then the rest in the order given, opens one whenever that makes the sum least, and at last
    opens the sequences that are not full again and deals their pieces anew in the first manner, if that makes fewer.
    """
    down = np.argsort(-lengths, kind="stable")
    best, places = _placed(lengths, down, room, True)
    made, out = best.made, np.empty((len(lengths), 2), np.int64)
    out[down] = places

    order = np.argsort(np.where(lengths > room // 2, -lengths, 0), kind="stable")
    opened, places = _placed(lengths, order, room, False)
    other = np.empty_like(out)
    other[order] = places
    unfilled = np.zeros(opened.made, bool)
    unfilled[[n for names in opened.names for n in names]] = True
    again = down[unfilled[other[down, 0]]]
    fresh, places = _placed(lengths, again, room, True)
    left = int(unfilled.sum())
    if fresh.made < left:
        other[again] = places + [[opened.made, 0]]
    if opened.made - left + min(left, fresh.made) < made:
        out = other
    return out[:, 0], out[:, 1]


def pieces(rows: DataFrame, tokenizer: str, end_id: int, room: int = ROOM, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of all rows, written once.

    A text's ids are those of the tokenizers library without special tokens added, then ``end_id``; a null text counts as
    empty and has the end id alone.  More than ``room`` ids are cut, so that only the first piece may be shorter.
    Null ids stay null, repeated rows have their pieces each, other columns are not looked at, and no rows give none.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = tokens(tokenizer)
        for batch in batches:
            texts, names = ["" if t is None else t for t in batch["text"]], batch["id"].to_numpy(object)
            sizes = np.cumsum([len(t) for t in texts])
            for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1):
                out = []
                for i, data in zip(group, own.encode([texts[i] for i in group]), strict=True):
                    data += end
                    for n, (start, length) in enumerate(cut(len(data) // 4, room)):
                        out.append((names[i], n, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
                yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32"])

    flat = rows.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    made = flat.mapInPandas(make, "id string, piece int, start long, length long, ids_crc32 long")
    return stage(made.withColumn("id", F.col("id").cast(rows.schema[id_column].dataType)), "sequences-pieces")


def pack(made: DataFrame, room: int = ROOM, items: int = ITEMS) -> DataFrame:
    """``pieces`` with sequence_id and offset: sequences of ``room`` ids at most, filled without gaps from 0 on.

    A piece of the whole room is a sequence by itself.  The others are dealt by a hash of their place to parts of about
    ``items``, and each part is packed in one task; as the sum of squares keeps what is lost of a part small against the part,
    parts lose little by not sharing sequences.  Ids are unique over all parts.
    """
    spotted = stage(made.withColumn("spot", F.monotonically_increasing_id()), "sequences-spotted")
    whole = spotted.filter(F.col("length") == room).withColumn("sequence_id", -1 - F.col("spot")).withColumn("offset", F.lit(0).cast("bigint"))
    others = spotted.filter(F.col("length") < room)
    parts = -(-others.count() // items) or 1

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("mixed", kind="stable")
        sequence, offset = fill(part["length"].to_numpy(), room)
        part["sequence_id"], part["offset"] = part["part"].to_numpy(np.int64) * 2**32 + sequence, offset
        return part.drop(columns=["mixed", "part"])

    mixed = others.withColumn("mixed", F.xxhash64("spot")).withColumn("part", F.pmod(F.xxhash64("spot", F.lit(1)), F.lit(parts)))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in spotted.schema.fields]
    packed = mixed.groupBy("part").applyInPandas(place, ", ".join([*names, "sequence_id long", "offset long"]))
    return packed.unionByName(whole).drop("spot")

