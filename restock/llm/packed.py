"""Token ids in binary files: fixed-width bit packing in blocks, with offsets for random access."""

from __future__ import annotations

import codecs
import functools
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.session import stage, work_path

MAGIC = b"IDBLOCK1"
HEAD = struct.Struct("<8sIIQQQ")  # at the file's end: magic, bits, ids a block, blocks, documents, ids
BLOCK_IDS = 65_536
READ_IDS = 1 << 20
KEPT = 400_000
KEPT_CHARS = 40
BATCH_CHARS = 4_000_000


def width(vocabulary: int) -> int:
    """Bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in ``bits`` bits each, lowest bit first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return octets[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The ``count`` ids in ``data``, as unsigned 32-bit integers."""
    if not count:
        return np.zeros(0, np.uint32)
    octets = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        octets[:, : bits // 8] = np.frombuffer(data, np.uint8)[: count * bits // 8].reshape(count, -1)
    else:
        cells = np.zeros((count, 32), np.uint8)
        cells[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
        octets = np.packbits(cells, axis=1, bitorder="little")
    return octets.view("<u4").reshape(-1)


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """A file: packed blocks, then block offsets, document starts, document ids with null flags, and the head.

    It is written under a name of its own and renamed when whole, so that a task that runs again or twice leaves one
    whole file.  Only the block that is being filled and the index are in memory.
    """

    def __init__(self, uri: str, bits: int, block_ids: int = BLOCK_IDS):
        self.fs, self.path = _place(uri)
        self.bits, self.block_ids = bits, block_ids
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.own)
        self.offsets, self.starts, self.names = [0], [0], []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.starts.append(self.starts[-1] + len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            ids = np.concatenate(self.waiting)
            whole = len(ids) - len(ids) % self.block_ids
            for at in range(0, whole, self.block_ids):
                self._put(ids[at : at + self.block_ids])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([n or 0 for n in self.names], "<i8").tobytes())
        self.out.write(np.array([n is None for n in self.names], np.uint8).tobytes())
        self.out.write(HEAD.pack(MAGIC, self.bits, self.block_ids, len(self.offsets) - 1, len(self.names), self.starts[-1]))
        self.out.close()
        self.fs.move(self.own, self.path)


class Reader:
    """Random access to the ids of a file: only the blocks that hold them are read."""

    def __init__(self, uri: str):
        place, path = _place(uri)
        self.file = place.open_input_file(path)
        end = self.file.size()
        magic, self.bits, self.block_ids, blocks, docs, self.count = HEAD.unpack(self._read(end - HEAD.size, HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"not a file of packed ids: {uri}")
        index = self._read(end - HEAD.size - 8 * (blocks + 1) - 17 * docs - 8, 8 * (blocks + 1) + 17 * docs + 8)
        cut = 8 * (blocks + 1)
        self.offsets = np.frombuffer(index[:cut], "<u8")
        self.starts = np.frombuffer(index[cut : cut + 8 * (docs + 1)], "<u8").astype(np.int64)
        cut += 8 * (docs + 1)
        names = np.frombuffer(index[cut : cut + 8 * docs], "<i8")
        missing = np.frombuffer(index[cut + 8 * docs :], np.uint8)
        self.names = [None if m else int(n) for n, m in zip(names, missing, strict=True)]

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        data = self._read(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        parts = []
        for b in range(first, last + 1):
            count = min(self.block_ids, self.count - b * self.block_ids)
            own = data[int(self.offsets[b] - self.offsets[first]) : int(self.offsets[b + 1] - self.offsets[first])]
            parts.append(unpack(own, self.bits, count))
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(name, start, ids) of each document in order, read some blocks at a time."""
        at = 0
        while at < len(self.names):
            stop = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + READ_IDS, "right")) - 1)
            base = int(self.starts[at])
            ids = self.ids(base, int(self.starts[stop]))
            for d in range(at, stop):
                yield self.names[d], int(self.starts[d]), ids[self.starts[d] - base : self.starts[d + 1] - base]
            at = stop


def _byte_characters() -> str:
    """The characters of byte-level tokenizers: a visible one of Latin-1 stands for itself, others for those from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return "".join(chr(b if b in seen else next(other)) for b in range(256))


BYTES = _byte_characters()


def bytewise(text: str) -> str:
    """A character for each byte of the text in UTF-8."""
    return codecs.charmap_decode(text.encode(), "strict", BYTES)[0]


class Tokens:
    """The ids that the tokenizers library gives for whole texts, with pre-tokens looked up that were met before.

    The library's byte-level pre-tokens are encoded on their own, so a text is cut into these, and only new ones go to the
    library.  They are cut by the library's rule, written out for the common characters of Latin script; a text with any
    other character, or with an added token of the tokenizer, goes to the library whole.  What was met is held in two
    generations of bounded size.  With ``plain`` the strings of special tokens are plain text.
    """

    SPACE, LETTER, NUMBER = "\t-\r \xa0", "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
    ODD = "[^\t-\r -~\xa0-\u024f\u2010-\u2027\u20ac]"
    CUT = re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.library, self.single = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.single.encode_special_tokens = True  # what is cut off has none
        self.single.pre_tokenizer = None  # it is one already, and given as the characters that stand for its bytes
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if not (plain and t.special)]
        self.odd = re.compile("|".join([self.ODD, *map(re.escape, added)]))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _known(self, words: Iterable[str]) -> dict[str, bytes]:
        """A dict that has all the words."""
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        own, old, new = self.young, self.old, []
        for w in set(words).difference(own):
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                own[w] = ids
        found = dict(zip(new, self._ids(self.single, list(map(bytewise, new))), strict=True))
        if not found or len(max(found, key=len)) <= KEPT_CHARS:
            own.update(found)
            return own
        own.update((w, ids) for w, ids in found.items() if len(w) <= KEPT_CHARS)
        return own | found

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [t for t in texts if self.odd.search(t)]
        whole = dict(zip(odd, self._ids(self.library, odd), strict=True))
        cut = [[] if t in whole else self.CUT.findall(t) for t in texts]
        get = self._known(chain.from_iterable(cut)).__getitem__
        return [whole[t] if t in whole else b"".join(map(get, words)) for t, words in zip(texts, cut, strict=True)]


@functools.lru_cache(maxsize=2)
def tokens(path: str, plain: bool = False) -> Tokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    return Tokens(path, plain)


def write(rows: DataFrame, tokenizer: str, end_id: int, vocabulary: int, text: str = "text", id_column: str = "doc_id", block_ids: int = BLOCK_IDS) -> tuple[str, DataFrame]:
    """Encode whole texts and write their ids, each followed by ``end_id``, in ascending order of the id column.

    Rows go by range of id to the tasks, and each task writes one file; a null id comes first, rows of one id in order of a
    hash of their texts, and even equal rows are dealt to several tasks if there are many.  A null text is empty: it has the end id alone.  An empty table gives no files.  Other columns are not
    looked at.  The files lie in the shared folder, whose file system the tasks must reach through pyarrow.
    Returns the folder and the files in order: (part, file, base, docs, ids); base is the number of ids before.
    """
    spark, bits = rows.sparkSession, width(vocabulary)
    folder = work_path(spark, "packed")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder
    folder = re.sub("^file:/(?!/)", "file:///", folder)
    end = np.array([end_id], "<u4").tobytes()

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, part, out = tokens(tokenizer), TaskContext.get().partitionId(), None
        name = f"part-{part:06d}.ids"
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            names = [None if n else int(v) for n, v in zip(batch["id"].isna(), batch["id"].fillna(0), strict=True)]
            ends = np.cumsum([len(t) for t in texts])
            for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // BATCH_CHARS)) + 1):
                for i, data in zip(group, own.encode([texts[i] for i in group]), strict=True):
                    out = out or Writer(f"{folder}/{name}", bits, block_ids)
                    out.add(names[i], np.frombuffer(data + end, "<u4"))
        if out:
            out.close()
            yield pd.DataFrame({"part": [part], "file": [name], "docs": [len(out.names)], "ids": [out.starts[-1]]})

    ordered = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    ties = [F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("spot")]
    ordered = ordered.select("*", *ties).repartitionByRange("id", "hash", "spot").sortWithinPartitions("id", "hash", "spot").select("id", "text")
    files = stage(ordered.mapInPandas(put, "part int, file string, docs long, ids long"), "packed-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, files.select("part", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"), "docs", "ids")


def read(folder: str, files: DataFrame) -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch["file"], batch["base"], strict=True):
                found = [
                    (doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc, start, ids in Reader(f"{folder}/{name}").documents()
                ]
                out = pd.DataFrame(found, columns=["id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"id": "Int64"})

    return files.repartition(max(1, files.count())).mapInPandas(get, "id long, start long, n_tokens long, ids_crc32 long")
