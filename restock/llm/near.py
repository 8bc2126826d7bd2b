"""Near duplicates: b-bit minhash signatures, a multi-index Hamming join over them, and links confirmed on full sets."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.storing import store
from restock.session import stage

SYMBOLS = 96  # of 16 bits each
DISTANCE = 35  # symbols in which a pair may differ; at a similarity of 0.8 the mean is 19.2, the deviation 3.9
ERRORS = 1  # symbols in which a chunk may differ
HEAD, HEADS = "head", 3  # first chunks of which a pair is made in one only
CHUNK_BIT = 57  # of a key, from which on it has its chunk
PERCENT = 80
SKETCH = ["s0", "s1", "s2"]
LEAD = ["l0", "l1", "l2"]
CARRIED = {**dict(zip(SKETCH, LEAD, strict=True)), "gone": "lead_gone"}
COUNTED = {"n": "lead_n", "common": "lead_common", "few": "lead_few"}
CROWD = 64  # members of a bucket from which on it pays to count shingles
RARE = 128  # classes of the crowds that a rare shingle is found in, at most
SIGNED = 8192  # classes whose keys a task makes
KEPT = 50_000
STEP = 4096
SLOTS = 1 << 20

_random = np.random.Generator(np.random.PCG64(20))
TIMES = _random.integers(0, 2**63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _random.integers(0, 2**63, SYMBOLS, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8, with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    """The set of ``width`` words in a row; with fewer words all as one, without words none."""
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(width)], strict=False))


class _Words(dict):
    """Hashes of words, computed once as long as they fit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


@functools.lru_cache(maxsize=1)
def _hashes() -> _Words:
    return _Words()


def hashed(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return _hashed(words(text), width)


def _hashed(w: list[bytes], width: int) -> np.ndarray:
    if not w:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(_hashes().__getitem__, w), np.uint64, len(w))
    span = min(width, len(w))
    out = np.full(len(w) - span + 1, span, np.uint64)
    for i in range(span):
        out = _mixed(out + own[i : len(own) - span + 1 + i])
    return np.unique(out)


def signature(values: np.ndarray) -> bytes:
    """16 bits of the least value under each of the hash functions."""
    least = np.full(SYMBOLS, 2**64 - 1, np.uint64)
    for at in range(0, len(values), STEP):
        part = values[at : at + STEP]
        least = np.minimum(least, (part[None] * TIMES[:, None] + PLUS[:, None]).min(1))
    return (_mixed(least) >> np.uint64(48)).astype("<u2").tobytes()


def chunks(distance: int = DISTANCE, errors: int = ERRORS) -> list[list[int]]:
    """Places of the symbols by chunk; of two signatures within the distance, a chunk differs in ``errors`` at most."""
    return [c.tolist() for c in np.array_split(np.arange(SYMBOLS), distance // (errors + 1) + 1)]


def keys(signatures: np.ndarray, distance: int = DISTANCE, errors: int = ERRORS) -> np.ndarray:
    """Keys of signatures, one row each: every chunk with every choice of ``errors`` symbols left out.  The chunk is in the
    highest seven bits."""
    places = np.arange(SYMBOLS, dtype=np.uint64) << np.uint64(16)
    terms = _mixed(signatures.astype(np.uint64) + places[None] + np.uint64(1))
    out = []
    for number, chunk in enumerate(chunks(distance, errors)):
        whole = terms[:, chunk].sum(1, dtype=np.uint64)
        for gone in combinations(chunk, min(errors, len(chunk))):
            left = whole - terms[:, list(gone)].sum(1, dtype=np.uint64)
            mixed = _mixed(left + np.uint64(sum(1 << (p % 48) for p in gone) + (chunk[0] << 50)))
            out.append((mixed >> np.uint64(7)) | np.uint64(number << CHUNK_BIT))
    return np.stack(out, 1).view(np.int64)


def sketch(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each symbol, 32 symbols in a 64-bit integer; one row each."""
    two = (signatures & 3).astype(np.uint64).reshape(len(signatures), -1, 32)
    return (two << np.arange(0, 64, 2, dtype=np.uint64)).sum(2, dtype=np.uint64).view(np.int64)


def _near(a: list[str], b: list[str], distance: int) -> Column:
    """Whether sketches differ in no more symbols than allowed.  True for all signatures within the distance."""
    total = F.lit(0)
    for x, y in zip(a, b, strict=True):
        d = F.col(x).bitwiseXOR(F.col(y))
        total = total + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total <= distance


def _describe(text: Column, width: int) -> Column:
    @F.pandas_udf("n long, d1 long, d2 long, signature binary, " + ", ".join(f"{c} long" for c in SKETCH))
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, d, s = [], [], []
            for t in texts:
                values = hashed(t, width)
                n.append(len(values))
                d.append(np.frombuffer(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), "<i8"))
                s.append(signature(values))
            d = np.array(d).reshape(len(n), 2)
            bits = sketch(np.frombuffer(b"".join(s), "<u2").reshape(len(n), SYMBOLS))
            yield pd.DataFrame(
                {"n": np.array(n, np.int64), "d1": d[:, 0], "d2": d[:, 1], "signature": pd.Series(s, dtype=object)}
                | {c: bits[:, i] for i, c in enumerate(SKETCH)}
            )

    return describe(text)


def left_out(signatures: np.ndarray, distance: int = DISTANCE, errors: int = ERRORS) -> np.ndarray:
    """For each key the symbol that it leaves out; -1 if it is its chunk's first key, or leaves out none or several.

    Signatures that agree in a whole chunk share all its keys, those that differ in one symbol the one key without it.  So of
    the keys that two signatures share in a chunk, exactly one is the first or leaves out symbols that differ.
    """
    out = []
    for chunk in chunks(distance, errors):
        for i, gone in enumerate(combinations(chunk, min(errors, len(chunk)))):
            one = len(gone) == 1 and i
            out.append(signatures[:, gone[0]].astype(np.int32) if one else np.full(len(signatures), -1, np.int32))
    return np.stack(out, 1)


def _once(a: str, b: str) -> Column:
    """Whether a shared key is the one of its chunk that counts."""
    return (F.col(a) == -1) | (F.col(a) != F.col(b))


def _keys(signatures: Column, distance: int, errors: int) -> Column:
    """A struct of the arrays ``key`` and ``gone``, what each key leaves out.

    Both come from one function: two would run side by side in two Python workers per task, which then stay.
    """

    @F.pandas_udf("key array<long>, gone array<int>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for data in batches:
            own = np.frombuffer(b"".join(data), "<u2").reshape(len(data), SYMBOLS)
            made = {"key": keys(own, distance, errors), "gone": left_out(own, distance, errors)}
            yield pd.DataFrame({c: pd.Series(list(x), dtype=object) for c, x in made.items()})

    return make(signatures)


def _pieces(distance: int, errors: int) -> list[list[tuple[int, int]]]:
    """(first byte, bytes) of the first chunks' symbols in a signature, in pieces of 64 bits at most."""
    return [[(2 * at, 2 * min(4, c[-1] + 1 - at)) for at in range(c[0], c[-1] + 1, 4)] for c in chunks(distance, errors)[:HEADS]]


def _heads(signature: Column, distance: int, errors: int) -> list[Column]:
    """The symbols of the first chunks as integers, four in each."""
    pieces = [p for chunk in _pieces(distance, errors) for p in chunk]
    return [F.conv(F.hex(F.substring(signature, at + 1, n)), 16, -10).cast("bigint").alias(f"{HEAD}{i}") for i, (at, n) in enumerate(pieces)]


def _not_before(distance: int, errors: int) -> Column:
    """Whether two rows of a key share none of the first chunks before that of the key."""
    number, out = 0, F.lit(True)
    for j, chunk in enumerate(_pieces(distance, errors)):
        differ = F.lit(0)
        for _, n in chunk:
            x = F.col(f"{HEAD}{number}").bitwiseXOR(F.col(f"other_{HEAD}{number}"))
            for lane in range(n // 2):
                mask = np.uint64(0xFFFF << 16 * lane).astype(np.int64)
                differ = differ + (x.bitwiseAND(F.lit(int(mask))) != 0).cast("int")
            number += 1
        out = out & ((F.shiftrightunsigned("key", CHUNK_BIT) <= j) | (differ > errors))
    return out


def _differ(a: Column, b: Column) -> Column:
    @F.pandas_udf("int")
    def differ(x: pd.Series, y: pd.Series) -> pd.Series:
        one, two = (np.frombuffer(b"".join(z), "<u2").reshape(len(z), SYMBOLS) for z in (x, y))
        return pd.Series((one != two).sum(1), dtype="int32")

    return differ(a, b)


def _linked(a: Column, b: Column, width: int, percent: int) -> Column:
    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        held = functools.lru_cache(maxsize=64)(lambda t: shingles(t, width))
        out = []
        for s, t in zip(x, y, strict=True):
            p, q = held(s), held(t)
            both = len(p & q)
            out.append(100 * both >= percent * (len(p) + len(q) - both) > 0)
        return pd.Series(out, dtype=bool)

    return linked(a, b)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either the least of its component or has one edge (u, v), to that."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low")).union(edges.select("v", F.lit(0)))
    counted = ends.groupBy("node").agg(F.sum("low").alias("low"), F.count("*").alias("all"))
    return not counted.agg(F.max((F.col("low") > 1) | ((F.col("low") == 1) & (F.col("all") > 1)))).first()[0]


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the links (a, b): root is the least node of the component.

    Large-star and small-star steps in turn: each node's neighbours are joined to the least of them, until only stars
    are left.  Only least neighbours are aggregated; no component is gathered.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "near-edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "near-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "near-edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) after more links: only the links between components are looked at."""
    one, two = (roots.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}")) for c in "ab")
    between = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("r_a", "a").alias("a"), F.coalesce("r_b", "b").alias("b"))
    moved = stage(connected(between), "near-moved")
    then = moved.select(F.col("node").alias("root"), F.col("root").alias("then"))
    known = roots.join(then, "root", "left").select("node", F.coalesce("then", "root").alias("root"))
    return stage(known.union(moved).distinct(), "near-roots")


def _shingle_hashes(text: Column, width: int) -> Column:
    @F.pandas_udf("array<long>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([hashed(t, width).view(np.int64) for t in texts], dtype=object)

    return make(text)


def _of(order: Column | str, carried: dict[str, str] = CARRIED) -> list[Column]:
    """What is carried by the member that comes first."""
    return [F.min_by(x, order).alias(y) for x, y in carried.items()]


def _pairs(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def rare_shingles(each: DataFrame, most: int) -> DataFrame:
    """(class, shingle, times) of the distinct rows (class, shingle) whose shingle comes ``most`` times at most.

    Of a shingle that comes once or twice, the least and the greatest class are all; only others meet their rows again.
    """
    times = each.groupBy("shingle").agg(F.count("*").alias("times"), F.min("class").alias("low"), F.max("class").alias("high"))
    times = stage(times.filter(F.col("times") <= most), "near-times")
    one = times.filter("times <= 2").select(F.col("low").alias("class"), "shingle", "times")
    two = times.filter("times = 2").select(F.col("high").alias("class"), "shingle", "times")
    more = each.join(times.filter("times > 2").select("shingle", "times"), "shingle").select("class", "shingle", "times")
    return one.unionByName(two).unionByName(more)


class Links:
    """Links between the rows of a written table (at, id, text); ``at`` is unique.

    Rows with the same words in the same order are one class, and only classes are compared.  Two classes are candidates if
    their signatures differ in ``distance`` symbols at most: by the pigeonhole, they then share a key of ``keys``.  Each key
    is a bucket, whose rows carry two bits of each symbol, so that most pairs that are too far apart never leave the join,
    and what the key leaves out, so that a pair comes out of a chunk once.
    Candidates that pass the signatures' distance and the sets' sizes are confirmed on the full texts.

    Members of a bucket that are in one component already need no pair.  So a bucket's members are first compared with its
    least member, then those outside its largest component with a member of that; at last all pairs of a bucket that
    still are in different components are compared, every one that may be similar by counts of its rare and its common
    shingles.  A group of near copies thus costs pairs in proportion to its rows, and no pair between components is left out.
    """

    def __init__(self, rows: DataFrame, width: int = 5, percent: int = PERCENT, distance: int = DISTANCE, errors: int = ERRORS):
        self.rows, self.width, self.percent, self.distance, self.errors = rows, width, percent, distance, errors
        described = rows.select("at", "id", _describe(F.col("text"), width).alias("s")).select("at", "id", "s.*")
        self.sets = stage(described, "near-sets")
        some = self.sets.filter("n > 0")
        self.classes = stage(
            some.groupBy("d1", "d2", "n").agg(F.min("at").alias("class"), F.min("id").alias("least"), F.coalesce(F.min_by("at", "id"), F.min("at")).alias("first")),
            "near-classes",
        )
        chosen = some.join(self.classes.select(F.col("class").alias("at")), "at", "left_semi")
        self.signed = stage(chosen.select(F.col("at").alias("class"), "n", "signature", *SKETCH), "near-signatures")

        keyed = self._keyed()
        leads = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("class").alias("lead"), F.min_by("gone", "class").alias("lead_gone"))
        # A bucket of two is done with its one pair; if that is too far apart, nothing is left of it.
        once = _once("gone", "lead_gone")
        members = keyed.join(leads.filter("size > 1"), "key").filter((F.col("class") != F.col("lead")) & ((F.col("size") > 2) | once))
        members = stage(members, "near-buckets")
        own = self.signed.select("class", *SKETCH)
        lead = self.signed.select(F.col("class").alias("lead"), *[F.col(x).alias(y) for x, y in zip(SKETCH, LEAD, strict=True)])
        near = once & _near(SKETCH, LEAD, distance)
        members = members.join(own, "class").join(lead, "lead").filter((F.col("size") > 2) | near)
        members = stage(members.withColumn("near", near), "near-members")

        self.links, self.tested, self._roots = None, None, None
        self._test(members.filter("near").select(*_pairs("class", "lead")))
        members = members.filter("size > 2")
        leaders = members.select("key", F.col("lead").alias("class"), *[F.col(y).alias(x) for x, y in CARRIED.items()]).distinct()
        self.buckets = stage(members.select("key", "class", *CARRIED).unionByName(leaders), "near-large")
        self._count_shingles()
        self._test(self._beside())
        self._test(self._across())

    def _keyed(self) -> DataFrame:
        """(class, key, gone) by key.

        A task makes the keys of ``SIGNED`` classes or so.  Nulls, of which there are none, are ruled out before the shuffle, as
        joins and aggregates do of their own accord: so all that is made of the keys reads one shuffle.
        """
        parts = -(-self.signed.count() // SIGNED)
        some = self.signed.filter("class is not null").select("class", "signature").repartition(max(1, parts), "class")
        made = some.select("class", _keys(F.col("signature"), self.distance, self.errors).alias("made"))
        keyed = made.select("class", F.inline(F.arrays_zip("made.key", "made.gone")))
        return keyed.filter("key is not null").repartition("key")

    def _held(self) -> DataFrame:
        return self.buckets.join(self._roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))

    def _count_shingles(self) -> None:
        """Look at the shingles of the members of crowded buckets with several components.

        ``rare`` are those that few, but several, of these classes have; ``few`` and ``common`` tell for each class how many
        of its n shingles are rare, and how many more of the classes have.  Two sets have in common what rare shingles they
        share, and no more of the others than either has; so near copies with changes of their own need not be compared
        with a whole group.
        """
        crowds = self._held().groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
        crowds = stage(crowds.filter((F.col("size") >= CROWD) & (F.col("low") < F.col("high"))).select("key"), "near-crowds")
        asked = stage(self.buckets.join(crowds, "key", "left_semi").select("class").distinct(), "near-crowded")
        texts = self._texts(asked.select("class")).join(asked.select(F.col("class").alias("at")), "at", "left_semi")
        each = texts.select(F.col("at").alias("class"), F.explode(_shingle_hashes(F.col("text"), self.width)).alias("shingle"))
        each = stage(each, "near-crowd-shingles")
        found = stage(rare_shingles(each, RARE), "near-rare")
        self.rare = found.filter("times > 1").select("class", "shingle")
        own = found.groupBy("class").agg(F.count("*").alias("own"), F.sum((F.col("times") > 1).cast("long")).alias("few"))
        counted = asked.join(self.signed.select("class", "n"), "class").join(own, "class", "left")
        common = (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")
        self.counted = stage(counted.select("class", "n", common, F.coalesce("few", F.lit(0)).alias("few")), "near-counted")

    def _possible(self, rare: Column | int = 0) -> Column:
        """Whether two sets that share so many rare shingles may be similar enough; true where that was not counted."""
        most = (F.least("common", "lead_common") + rare) * (100 + self.percent) >= (F.col("n") + F.col("lead_n")) * self.percent
        return F.when(F.col("common").isNotNull() & F.col("lead_common").isNotNull(), most).otherwise(True)

    def _mixed_buckets(self) -> DataFrame:
        """Members of buckets that hold several components, with the component, the bucket's largest and a member of that."""
        held = self._held().join(self.counted, "class", "left")
        held = stage(held.select("key", "class", *CARRIED, *COUNTED, "root"), "near-held")
        some = F.xxhash64("key", "class")
        by_root = held.groupBy("key", "root").agg(F.count("*").alias("members"), F.min_by("class", some).alias("lead"), *_of(some, CARRIED | COUNTED))
        lead = ("lead", *CARRIED.values(), *COUNTED.values())
        top = by_root.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("members", "root", *lead)).alias("top")).filter("roots > 1")
        top = stage(top.select("key", F.col("top.root").alias("top"), *[F.col(f"top.{c}").alias(c) for c in lead]), "near-top")
        return held.join(top, "key")

    def _beside(self) -> DataFrame:
        near = self._possible() & _once("gone", "lead_gone") & _near(SKETCH, LEAD, self.distance)
        return self._mixed_buckets().filter("root <> top").filter(near).select(*_pairs("class", "lead"))

    def _across(self) -> DataFrame:
        members = stage(self._mixed_buckets().select("key", "class", "root", "top", *CARRIED, *COUNTED), "near-mixed")

        def others(rows: DataFrame, *more: str) -> DataFrame:
            heads = {c: f"other_{c}" for c in rows.columns if c.startswith(HEAD)}
            renamed = {"class": "other", "root": "other_root", **heads, **CARRIED, **COUNTED}
            return rows.select(*more, *[F.col(x).alias(y) for x, y in renamed.items() if x in rows.columns])

        near = _near(SKETCH, LEAD, self.distance) & (F.col("root") != F.col("other_root"))
        # Of two minor members the pair is made by the greater one, and not again if a first chunk has made it.
        once = _once("gone", "lead_gone") & ((F.col("root") == F.col("top")) | (F.col("class") < F.col("other")))
        heads = self.signed.select("class", *_heads(F.col("signature"), self.distance, self.errors))
        headed = stage(members.join(heads, "class"), "near-mixed-heads")
        met = headed.join(others(headed.filter("root <> top"), "key"), "key")
        within = met.filter(self._possible() & once & near & _not_before(self.distance, self.errors))
        # Pairs that only the rare shingles they share may make similar enough.
        able = (F.col("common") + F.col("few")) * 100 >= F.col("n") * self.percent  # two similar sets share as much of either
        known = members.filter(F.col("common").isNotNull() & able).select("class", "root", *SKETCH, *COUNTED).distinct()
        rare = stage(self.rare.join(known, "class"), "near-rare-members")
        may = self._possible(F.least("few", "lead_few")) & ~self._possible()
        sharing = rare.join(others(rare, "shingle"), "shingle").filter((F.col("class") < F.col("other")) & may & near)
        sharing = sharing.groupBy("class", "other", *COUNTED, *COUNTED.values()).agg(F.count("*").alias("rare"))
        sharing = sharing.filter(self._possible(F.col("rare")))
        return within.select(*_pairs("class", "other")).union(sharing.select(*_pairs("class", "other")))

    def _test(self, pairs: DataFrame) -> None:
        """Confirm pairs of classes not tested before; then find the components anew."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-pairs")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        one, two = (self.signed.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}")) for c in "ab")
        near = pairs.join(one, "a").join(two, "b").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
        near = near.withColumn("distance", _differ(F.col("s_a"), F.col("s_b"))).filter(F.col("distance") <= self.distance)
        near = stage(near.select("a", "b"), "near-candidates")

        texts = self._texts(near.select("a").union(near.select("b")))
        one, two = (texts.select(F.col("at").alias(c), F.col("text").alias(f"t_{c}")) for c in "ab")
        found = near.join(one, "a").join(two, "b").filter(_linked(F.col("t_a"), F.col("t_b"), self.width, self.percent))
        found = stage(found.select("a", "b"), "near-links")
        self.links = found if self.links is None else self.links.unionByName(found)
        self._roots = connected(found) if self._roots is None else joined(self._roots, found)

    def _texts(self, asked: DataFrame) -> DataFrame:
        """(at, text) of the rows asked for and of some others.

        The slots of the ids asked for, ``SLOTS`` at most, thin out the texts before they are shuffled.
        """

        def slot(c: str) -> Column:
            return F.pmod(F.xxhash64(c), F.lit(SLOTS)).alias("slot")

        slots = asked.select(slot(asked.columns[0])).distinct()
        return self.rows.select("at", "text", slot("at")).join(F.broadcast(slots), "slot", "left_semi").select("at", "text")

    def components(self) -> DataFrame:
        """Per row: at, id, n_shingles, component_id (the least id of the component) and stays, true for one row of each.

        A row without shingles is alone.  Ids that are null count only where a component has no other; then component_id is null.
        """
        held = self.classes.join(self._roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        held = stage(held, "near-rooted")
        least = held.groupBy("root").agg(F.min("least").alias("component_id"), F.coalesce(F.min_by("first", "least"), F.min("first")).alias("stay"))
        held = stage(held.join(stage(least, "near-least"), "root").select("d1", "d2", "n", "component_id", "stay"), "near-components")
        some = self.sets.filter("n > 0").join(held, ["d1", "d2", "n"])
        some = some.select("at", "id", F.col("n").alias("n_shingles"), "component_id", (F.col("at") == F.col("stay")).alias("stays"))
        none = self.sets.filter("n = 0").select("at", "id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("stays"))
        return some.unionByName(none)


def written(rows: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(at, id, text) of all rows, written once so that ``at`` holds."""
    return store(rows.select(F.monotonically_increasing_id().alias("at"), F.col(id_column).alias("id"), F.col(text).alias("text")), "near-texts")


def deduplicate(rows: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows that stay, one of each component, with all their columns."""
    kept = store(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "near-rows")
    flat = kept.select("at", F.col(f"row.`{id_column}`").alias("id"), F.col(f"row.`{text}`").alias("text"))
    stays = Links(flat, **options).components().filter("stays")
    return kept.join(stays.select("at"), "at", "left_semi").select("row.*")
