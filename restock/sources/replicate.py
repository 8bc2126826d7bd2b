"""Copying tables from a source to a target: whole, by batch, by day, or all tables of a schema."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.operators.keysets import null_safe_semi
from restock.session import stage
from restock.sources.keyed import KeyedStore
from restock.sources.store import Store

# Tables never copied.  The underscore is literal.
SKIP_PATTERNS = (r"%\_1\_prt\_%", r"%\_bak", r"%\_tmp", "tmp%")


def sync_full(source: DataFrame, target: Store) -> None:
    """Replace the target by all rows of the source."""
    target.replace(source)


def _replace_partitions(rows: DataFrame, target: Store) -> None:
    target.replace_partitions(rows, rows.select(target.partition).distinct())


def sync_batches(source: DataFrame, target: Store, batches: Sequence[int]) -> None:
    """Copy some batches, by the target's partition column; the target keeps its other batches."""
    _replace_partitions(source.filter(F.col(target.partition).isin(*batches)), target)


def sync_day(source: DataFrame, target: Store, day: str) -> None:
    """Copy one day, by the target's partition column; the target keeps its other days."""
    _replace_partitions(source.filter(F.col(target.partition) == F.lit(day).cast("date")), target)


def digests(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group the number of rows and two sums of hashes of whole rows, which no order of the rows changes.

    Two groups with the same rows have the same digest; with different rows they have it by chance only (2^-64 for each of the
    two sums).  Hashes are summed where the rows are, so what is shuffled has the size of the groups.
    """
    whole = [F.col(f"`{c}`") for c in sorted(rows.columns)]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *whole).cast("decimal(38,0)"))

    return rows.groupBy(*by).agg(F.count("*").alias("_rows"), total(1).alias("_one"), total(2).alias("_two"))


def differing(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose rows differ, with ``kind``: new (not in the target), gone (not in the source) or changed.  NULL is a
    group like others."""
    both = digests(source, by).withColumn("_side", F.lit(1)).unionByName(digests(target.select(*source.columns), by).withColumn("_side", F.lit(2)))
    figures = F.struct("_rows", "_one", "_two")
    one, two = (F.max(F.when(F.col("_side") == side, figures)).alias(name) for side, name in ((1, "_s"), (2, "_t")))
    kind = F.when(F.col("_t").isNull(), "new").when(F.col("_s").isNull(), "gone").when(~F.col("_s").eqNullSafe(F.col("_t")), "changed")
    return both.groupBy(*by).agg(one, two).select(*by, kind.alias("kind")).filter(F.col("kind").isNotNull())


def sync_changed(source: DataFrame, target: Store) -> DataFrame:
    """Copy only the partitions in which source and target differ; these, by the target's partition column, with ``kind``.

    Both sides are compared by digests, so that a table without changes is read but not written.  Without a partition column the
    table is one partition.  Another writer's change of a partition that is copied is a conflict.
    """
    number, by = target.head(), [target.partition] if target.partition else []
    source = source.select(*target.schema.names)
    found = stage(differing(source, target.current(), by), "differing")
    if not found.isEmpty():
        if by:
            target.replace_partitions(null_safe_semi(source, found, by), found, number)
        else:
            target.replace(source, number)
    return found


def sync_keys(source: DataFrame, target: KeyedStore, spans: int = 1024) -> DataFrame:
    """Copy only the keys whose rows differ; these with ``kind``.

    The digests of ``spans`` spans of keys, by hash, tell which spans differ; only in these are keys compared one by one, and only
    the keys that differ are written.
    """
    number, key, columns = target.head(), target.key, target.schema.names
    span = F.pmod(F.xxhash64(key), F.lit(spans)).alias("_span")
    ours, theirs = (rows.select(*columns, span) for rows in (source, target.current(number)))
    spread = stage(differing(ours, theirs, ["_span"]).select("_span"), "differing-spans")
    some = [rows.join(spread, "_span", "left_semi").select(*columns) for rows in (ours, theirs)]
    found = stage(differing(*some, [key]), "differing-keys")
    if not found.isEmpty():
        fresh = null_safe_semi(some[0], found.filter("kind <> 'gone'"), [key])
        target.upsert(fresh, found.filter("kind = 'gone'").select(key), number)
    return found


def catalog_columns(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Column list of some tables as rows, from their schemas."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(pa.table(list(zip(*rows)), names=["table", "column", "type"]))


def sync_plan(columns: DataFrame, deny: Iterable[str] = (), batch_column: str = "batch_id") -> DataFrame:
    """Which tables to copy and how: by batch if the table has an integer batch column, else whole.  By name."""
    wanted = ~F.col("table").isin(*deny)
    for pattern in SKIP_PATTERNS:
        wanted = wanted & ~F.col("table").like(pattern)
    is_batch = (F.col("column") == batch_column) & (F.col("type") == "int")
    return (
        columns.filter(wanted)
        .groupBy("table")
        .agg(F.max(is_batch).alias("has_batch"))
        .withColumn("mode", F.when(F.col("has_batch"), "batches").otherwise("full"))
        .orderBy("table")
    )


def sync_tables(
    plan: DataFrame, tables: Mapping[str, DataFrame], target_root: str, batches: Sequence[int], batch_column: str = "batch_id"
) -> dict[str, Store]:
    """Carry out a plan, one Spark job per table; the copies by name.  The plan has one row per table."""
    done = {}
    for row in plan.collect():
        source, by_batch = tables[row.table], row.mode == "batches" and batches
        target = Store(source.sparkSession, f"{target_root}/{row.table}", source.schema, batch_column if by_batch else None)
        if by_batch:
            sync_batches(source, target, batches)
        else:
            sync_full(source, target)
        done[row.table] = target
    return done


def parse_batches(text: str) -> list[int]:
    """Batch ids written as comma-separated text."""
    return [int(x) for x in re.findall(r"\d+", text)]
