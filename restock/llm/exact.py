"""Exact duplicates by naming: equal blocks get equal integers, and so do equal pairs of neighbours, up to one per text."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.storing import store
from restock.session import stage

SPACE = "[\\x20\\x09-\\x0D]+"
BLOCK_BYTES = 4096
BUCKETS = 65536


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def routes(seed: int, block: Column) -> list[Column]:
    """Where a block's name is decided: 128 bits of it.  They bring blocks together and never decide equality."""
    return [F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)]


def _number(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with an integer ``name``: their order within a bucket, after the bucket's number."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    order = Window.partitionBy("bucket").orderBy(*keys)
    return distinct.withColumn("bucket", bucket).select(*keys, (F.col("bucket") * F.lit(1 << 40) + F.row_number().over(order)).alias("name"))


def _blocks(text: Column, block_bytes: int) -> Column:
    data, last = text.cast("binary"), F.floor((F.greatest(F.octet_length(text), F.lit(1)) - 1) / block_bytes)
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def identities(
    rows: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    at: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    route: Callable[[int, Column], list[Column]] = routes,
) -> DataFrame:
    """Per row: at, id, level, name, text_sha256.  Two rows have the same (level, name) if and only if their texts are equal.

    Texts are cut into blocks of a fixed number of bytes.  The distinct blocks are sorted and numbered; then pairs of
    neighbours are, level by level, until each text has one number.  Texts of different block counts end on different
    levels or on pairs with a gap.  Blocks travel once, combined before the shuffle, and are compared in full there: if
    two different blocks had the same route, other routes are taken.  Joins are on integers, and adaptive execution
    splits the hot ones.  Nulls count as empty.  ``at`` is unique per row, also for repeated rows: the column named so, or
    one made here.  Other columns are not looked at.
    """
    spot = F.col(at) if at else F.monotonically_increasing_id()
    source = rows.select(spot.alias("at"), F.col(id_column).alias("id"), normalised(F.col(text)).alias("text"))
    for seed in itertools.count():
        ways = _blocks(F.col("text"), block_bytes)
        cut = source.select(
            "at", "id", F.sha2("text", 256).alias("text_sha256"),
            F.transform(ways, lambda b: F.struct(*[r.alias(f"r{i}") for i, r in enumerate(route(seed, b))])).alias("routes"),
        )
        distinct = source.select(F.explode(ways).alias("block"))
        keys = [f"r{i}" for i in range(len(route(seed, F.lit(b""))))]
        distinct = distinct.select(*[r.alias(k) for k, r in zip(keys, route(seed, F.col("block")), strict=True)], "block").distinct()
        met = stage(distinct.groupBy(*keys).agg(F.count("*").alias("different")), "exact-blocks")
        if met.filter("different > 1").isEmpty():
            break
    cut = stage(cut, "exact-texts")
    longest = cut.agg(F.max(F.size("routes"))).first()[0] or 1
    named = (
        cut.select("at", "id", F.size("routes").alias("n"), F.posexplode("routes").alias("i", "route"))
        .select("at", "id", "n", "i", "route.*")
        .join(_number(met.select(*keys), keys), keys)
        .select("at", "id", "n", "i", "name")
    )
    done, level = [], 0
    while True:
        named = stage(named, f"exact-level{level}")
        done.append(named.filter("n = 1").select("at", "id", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        longest, level = (longest + 1) // 2, level + 1
        even = F.col("i") % 2 == 0
        pairs = (
            named.filter("n > 1")
            .groupBy("at", "id", F.floor((F.col("n") + 1) / 2).alias("n"), F.floor(F.col("i") / 2).alias("i"))
            .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        )
        names = _number(pairs.select("a", "b").distinct(), ["a", "b"])
        named = pairs.join(names, ["a", "b"]).select("at", "id", "n", "i", "name")
    return _union(done).join(cut.select("at", "text_sha256"), "at")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def groups(rows: DataFrame, text: str = "text", id_column: str = "doc_id", at: str | None = None, **options) -> DataFrame:
    """Per row: at, id, keep_id (the smallest id of equal texts), group_size, kept, text_sha256.

    One row of a group is kept.  A null id comes after all others, and of repeated rows with one id a single one stays.
    """
    found = identities(rows, text, id_column, at, **options)
    met = found.groupBy("level", "name").agg(
        F.min("id").alias("keep_id"),
        F.count("*").alias("group_size"),
        F.coalesce(F.min_by("at", "id"), F.min("at")).alias("keep_at"),
    )
    met = stage(met, "exact-groups")  # both sides of the join then are plain exchanges, and a hot name is split
    return found.join(met, ["level", "name"]).select(
        "at", "id", "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept"), "text_sha256"
    )


def deduplicate(rows: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = store(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "exact-rows")
    found = groups(kept.select("at", F.col(f"row.`{id_column}`").alias("id"), F.col(f"row.`{text}`").alias("text")), "text", "id", "at", **options)
    return kept.join(found.filter("kept").select("at"), "at", "left_semi").select("row.*")
