"""Grouped aggregates kept up to date by what changed in their input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.session import stage
from restock.sources.keyed import KeyedStore

CELL, ROWS = "_cell", "_rows"


@dataclass(frozen=True)
class Aggregates:
    """Sums, least and greatest values by ``keys``; each column is an expression over the input rows.

    A sum of no values is NULL in SQL; here sums are over expressions that are never NULL.
    """

    keys: Sequence[str]
    sums: Mapping[str, Column]
    lows: Mapping[str, Column] = field(default_factory=dict)
    highs: Mapping[str, Column] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.keys, *self.sums, *self.lows, *self.highs]

    def _cell(self) -> Column:
        """The keys as one text, NULL told from any value."""
        return F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"}).alias(CELL)

    def _combined(self, rows: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
        """Rows summed per keys, ``more`` columns and each text whose least or greatest value is looked up.

        Those figures have a fixed length, so that they are aggregated in a hash table; a text would have every row sorted.
        """
        ends = {**self.lows, **self.highs}
        kinds = {f.name: f.dataType for f in rows.select(*[c.alias(n) for n, c in ends.items()]).schema}
        texts = [ends[n].alias(n) for n in ends if isinstance(kinds[n], T.StringType)]
        figures = [F.sum(c).alias(n) for n, c in self.sums.items()]
        for own, names in ((F.min, self.lows), (F.max, self.highs)):
            figures += [own(c).alias(n) for n, c in names.items() if not isinstance(kinds[n], T.StringType)]
        return rows.groupBy(*self.keys, *more, *texts).agg(*figures, F.count("*").alias(ROWS))

    def full(self, rows: DataFrame) -> DataFrame:
        """All groups, with the number of their rows."""
        some = self._combined(rows)
        types = {f.name: f.dataType for f in some.schema}
        figures = [F.sum(n).cast(types[n]).alias(n) for n in self.sums]
        figures += [F.min(n).alias(n) for n in self.lows] + [F.max(n).alias(n) for n in self.highs]
        return some.groupBy(*self.keys).agg(*figures, F.sum(ROWS).alias(ROWS)).select(self._cell(), *self.names, ROWS)

    def delta(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """Per group the signed sums of the rows that came and went, and the ends of either: ``in_`` and ``out_``."""
        sides = [self._combined(rows, [F.lit(sign).alias("_sign")]) for rows, sign in ((before, -1), (after, 1))]
        sign = F.col("_sign")
        figures = [F.sum(F.col(n) * sign).alias(n) for n in self.sums] + [F.sum(F.col(ROWS) * sign).cast("bigint").alias(ROWS)]
        for name, own in ((n, f) for f, names in ((F.min, self.lows), (F.max, self.highs)) for n in names):
            figures += [own(F.when(sign == s, F.col(name))).alias(f"{side}_{name}") for side, s in (("out", -1), ("in", 1))]
        return sides[0].unionByName(sides[1]).groupBy(*self.keys).agg(*figures)


def start(store: KeyedStore, aggregates: Aggregates, rows: DataFrame) -> None:
    """Compute all groups once."""
    store.replace(aggregates.full(rows).select(*store.schema.names))


def schema(aggregates: Aggregates, rows: DataFrame):
    """The schema of the table that holds the groups; its key is ``CELL``."""
    return aggregates.full(rows).schema


def refresh(store: KeyedStore, aggregates: Aggregates, before: DataFrame, after: DataFrame, rows: DataFrame) -> DataFrame:
    """Bring the stored groups up to date: ``before`` rows were replaced by ``after`` rows, ``rows`` are all rows afterwards.

    Sums are stored sums plus signed ones.  A least or greatest value is the better of the stored and the new one, unless rows
    that held it have gone; only the groups where that is so are aggregated again, from their own rows.  Groups without rows
    vanish.  Returns the keys of the groups that were aggregated again.
    """
    number = store.head()
    delta = stage(aggregates.delta(before, after).select(aggregates._cell(), "*"), "delta")
    renamed = [F.col(c).alias(f"_d_{c}") for c in delta.columns]
    touched = store.current(number).join(delta.select(*renamed), F.col(CELL) == F.col(f"_d_{CELL}"), "right")
    left = F.coalesce(ROWS, F.lit(0)) + F.col(f"_d_{ROWS}")
    stale = F.lit(False)
    values = {k: F.col(f"_d_{k}") for k in (CELL, *aggregates.keys)} | {ROWS: left}
    for n in aggregates.sums:
        values[n] = F.coalesce(F.col(n), F.lit(0)) + F.col(f"_d_{n}")
    for names, better, order in ((aggregates.lows, F.least, 1), (aggregates.highs, F.greatest, -1)):
        for n in names:
            come, gone = F.col(f"_d_in_{n}"), F.col(f"_d_out_{n}")
            values[n] = better(F.col(n), come)
            lost = gone == F.col(n)
            held = F.coalesce((come <= gone) if order == 1 else (come >= gone), F.lit(False))
            stale = stale | F.coalesce(lost & ~held, F.lit(False))
    types = {f.name: f.dataType for f in store.schema}
    fresh = touched.select(*[values[n].cast(types[n]).alias(n) for n in store.schema.names], stale.alias("_stale"))
    fresh = stage(fresh, "refreshed")
    again = fresh.filter("_stale").filter(F.col(ROWS) > 0).select(*aggregates.keys)
    good = fresh.filter(~F.col("_stale") & (F.col(ROWS) > 0)).drop("_stale")
    if not again.isEmpty():
        wanted = again.select(*[F.col(k).alias(f"_k_{k}") for k in aggregates.keys])
        on = F.lit(True)
        for k in aggregates.keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        anew = aggregates.full(rows.join(wanted, on, "left_semi"))
        good = good.unionByName(anew.select(*store.schema.names))
    store.upsert(good, fresh.filter(F.col(ROWS) <= 0).select(CELL), number)
    return again
