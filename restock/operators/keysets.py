"""Key sets: which documents a change touches, and joins that use a key set as a filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.functions import columns as C
from restock.session import stage

ORG_ROLES = ("model_out_org", "model_in_org", "out_org", "in_org")

def two_sided_keys(lines: DataFrame, roles: Sequence[str] = ("out_org", "in_org")) -> DataFrame:
    """Distinct (org, skc) over several org columns, from one scan; missing orgs are left out."""
    return (
        lines.select(F.explode(F.array(*roles)).alias("org"), "skc").filter(F.col("org").isNotNull()).distinct()
    )


def changed_pairs(lines: DataFrame) -> DataFrame:
    """(org, skc) of changed lines, either side; a missing org counts as the sentinel org."""
    orgs = F.array(C.org_or_sentinel("out_org"), C.org_or_sentinel("in_org"))
    return lines.filter(C.is_changed("status")).select(F.explode(orgs).alias("org"), "skc").distinct()


def touching(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Lines that touch one of the (org, skc) pairs in any of the four org roles.

    Each distinct combination of roles and article is tested once; combinations combine before they are shuffled and are
    far fewer than lines.  The lines are then kept by combination, with whatever join the written set's size allows.
    """
    combos = lines.select(*ORG_ROLES, "skc").distinct()
    exploded = combos.withColumn("org", F.explode(F.array_distinct(F.array(*ORG_ROLES))))
    hits = exploded.join(pairs, ["org", "skc"], "left_semi").select(*ORG_ROLES, "skc").distinct()
    return null_safe_semi(lines, stage(hits, "touched"), (*ORG_ROLES, "skc"))


def null_safe_semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Semi join in which NULL keys match each other."""
    renamed = keys.select(*[F.col(c).alias(f"_k_{c}") for c in on])
    condition: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in on])
    return df.join(renamed, condition, "left_semi")


def unchanged_pairs(affected: DataFrame, pairs: DataFrame) -> DataFrame:
    """(org, skc) of affected documents that did not change themselves: stores whose stored figures are kept."""
    return two_sided_keys(affected, ORG_ROLES).join(pairs, ["org", "skc"], "left_anti")


def by_key_set(df: DataFrame, keys: DataFrame, on: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is in a key set; with ``columns``, add those columns of the set (unique on the key)."""
    on = list(on)
    if not columns:
        return df.join(keys.select(*on), on, "left_semi")
    return df.join(keys.select(*on, *columns).dropDuplicates(on), on)


def has_changes(lines: DataFrame) -> DataFrame:
    """One row telling whether any line is changed; each task stops at the first one it finds."""
    found = lines.filter(C.is_changed("status")).select(F.lit(1).alias("one")).limit(1)
    return found.agg((F.count("*") > 0).alias("has_changes"))
