"""Enrichment joins of documents with dimensions and per-org figures."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
SEP = ","
TOGETHER = "spark.sql.requireAllClusterKeysForCoPartition"

def complete_sizes(keys: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Each key row with every size its article comes in; an article without sizes keeps one row."""
    return keys.join(dim_sku.select("skc", "size", "sku"), "skc", "left")


def side_lookup(
    docs: DataFrame,
    facts: DataFrame,
    sides: Mapping[str, str],
    values: Sequence[str],
    on: Sequence[str] = (),
    org: str = "org",
) -> DataFrame:
    """Look up one fact row per (org, on…) for several org columns of a document.

    ``sides`` maps a prefix to the org column to look up, so ``{"out": "out_org"}`` adds ``out_<value>``.
    """
    result = docs
    for prefix, side in sides.items():
        renamed = facts.select(
            F.col(org).alias(side), *on, *[F.col(v).alias(f"{prefix}_{v}") for v in values]
        )
        result = result.join(renamed, [side, *on], "left")
    return result


def packed_lookup(
    docs: DataFrame,
    facts: DataFrame,
    sides: Mapping[str, str],
    values: Sequence[str],
    on: Sequence[str] = (),
    org: str = "org",
    name: str = "facts",
    alike: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """As ``side_lookup`` for many values: each side adds one struct, ``<prefix>_<name>``, to be opened by ``unpack``.

    A chain of joins then takes a wide side as one value.  The values of one type are one array, so that the chain has few
    enough fields for Spark to compile it as a whole: then a side is not copied by each join that follows, but once by the last.
    With ``alike``, documents and facts are dealt out by ``beside``.
    """
    result = docs
    for prefix, side in sides.items():
        packed = facts.select(F.col(org).alias(side), *on, _packed(facts, values).alias(f"{prefix}_{name}"))
        if alike is None:
            result = result.join(packed, [side, *on], "left")
        else:
            result = result.join(alike(packed), [side, *on, PART], "left")
    return result


def _packed(facts: DataFrame, values: Sequence[str]) -> Column:
    """A struct with an array for each type that several values have, named by all of these, and the other values as they are."""
    by_type: dict[T.DataType, list[str]] = {}
    for v in values:
        by_type.setdefault(facts.schema[v].dataType, []).append(v)
    return F.struct(*[F.array(*names).alias(SEP.join(names)) if len(names) > 1 else F.col(names[0]) for names in by_type.values()])


def beside(
    rows: DataFrame, by: str | Sequence[str], spread_by: str, parts: int = 200, spread: int = 4
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows dealt out for look-ups whose keys all hold ``by``, and a function that deals out facts alike.

    Joined on their keys and ``PART``, rows and facts lie together already: the rows are shuffled once, before any wide fact is
    attached, and no row is shuffled, sorted or spilled with its facts.  A task holds the facts of a value of ``by``, so these must be
    bounded by dimensions; the rows of a value go to ``spread`` tasks, each of which gets its facts.
    """
    by = [by] if isinstance(by, str) else list(by)
    # Without this Spark shuffles again what lies together by some of a join's keys only.
    settings = rows.sparkSession.conf
    if TOGETHER not in settings.getAll:
        settings.set(TOGETHER, "false")
    part = F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int")

    def alike(facts: DataFrame) -> DataFrame:
        copies = facts.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        return copies.repartition(parts, *by, PART).hint("shuffle_hash")

    return rows.withColumn(PART, part).repartition(parts, *by, PART), alike


def unpack(docs: DataFrame, packed: Mapping[str, str]) -> DataFrame:
    """Open struct columns, and their arrays that are named by several values; ``packed`` maps each to the prefix of its fields."""
    columns: list[Column] = []
    for c in docs.columns:
        if c in packed:
            prefix = f"{packed[c]}_" if packed[c] else ""
            for f in docs.schema[c].dataType.names:
                names = f.split(SEP)
                fields = [F.get(F.col(c)[f], F.lit(i)) for i in range(len(names))] if len(names) > 1 else [F.col(c)[f]]
                columns += [field.alias(f"{prefix}{n}") for field, n in zip(fields, names, strict=True)]
        else:
            columns.append(F.col(c))
    return docs.select(*columns)


def filtered_lookup(df: DataFrame, facts: DataFrame, condition: Column, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join with the part of a table that meets a condition."""
    return df.join(facts.filter(condition).select(*on, *values), list(on), "left")
