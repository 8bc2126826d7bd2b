"""Size detail with totals, and the key/value bundles made from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "total"


def with_totals(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str] | Sequence[str], size: str = "size"
) -> DataFrame:
    """Sums per (keys, size) and per keys in one pass.

    The total row carries the size ``total`` and ``grouping_id`` 1, so a size that is NULL in the data is not
    mistaken for it.  Both levels are combined on the map side before the one shuffle.
    """
    sums, totals = _sums(sums)
    detail = [F.col(k) for k in (*keys, size)]
    grouped = df.groupingSets([detail, detail[:-1]], *detail).agg(*totals, F.grouping(size).alias("_total"))
    return grouped.select(
        *keys,
        F.when(F.col("_total") == 1, F.lit(TOTAL)).otherwise(F.col(size)).alias(size),
        *sums,
        F.col("_total").cast("int").alias("grouping_id"),
    )


def _sums(sums: Mapping[str, Column | str] | Sequence[str]) -> tuple[Sequence[str], list[Column]]:
    named = sums if isinstance(sums, Mapping) else {name: name for name in sums}
    return list(named), [F.sum(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in named.items()]


def total_bundle(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str] | Sequence[str], size: str = "size"
) -> DataFrame:
    """What ``bundle`` makes of ``with_totals``, without a second set of rows for the totals.

    Figures are summed per (keys, size), gathered once per keys, and the total joins the list there.
    """
    names, totals = _sums(sums)
    per_size = df.groupBy(*keys, F.col(size).alias("_key")).agg(*totals)
    listed = F.collect_list(F.struct(F.col("_key").alias("key"), *names))
    gathered = per_size.groupBy(*keys).agg(listed.alias("_rows"), F.struct(*[F.sum(n).alias(n) for n in names]).alias("_sum"))
    last = F.struct(F.lit(TOTAL).alias("key"), *[F.col("_sum")[n].alias(n) for n in names])
    gathered = gathered.withColumn("_rows", F.sort_array(F.concat("_rows", F.array(last))))
    return gathered.select(*keys, *[_metric_json("_rows", m).alias(m) for m in names])


def bundle(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], size: str = "size") -> DataFrame:
    """One JSON text per metric and group: ``[{"key": size, "value": number}, …]`` sorted by key.

    Expects one row per (keys, size), as ``with_totals`` gives; a group then has as many elements as there are
    sizes, plus one.  All metrics of a group are gathered once and split afterwards.
    """
    rows = F.sort_array(F.collect_list(F.struct(F.col(size).alias("key"), *metrics)))
    gathered = df.groupBy(*keys).agg(rows.alias("_rows"))
    return gathered.select(*keys, *[_metric_json("_rows", m).alias(m) for m in metrics])


def _metric_json(rows: str, metric: str) -> Column:
    pairs = F.transform(F.col(rows), lambda r: F.struct(r["key"].alias("key"), r[metric].alias("value")))
    return F.to_json(pairs, {"ignoreNullFields": "false"})
