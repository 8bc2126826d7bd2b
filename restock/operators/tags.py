"""Tags kept at article, org and org×article grain: spread, union, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUFFIX = "_tag_value"


def union_tags(keys: DataFrame, skc_tags: DataFrame, org_tags: DataFrame, pair_tags: DataFrame) -> DataFrame:
    """Tags of all three grains for each (org, skc) key."""
    columns = ["org", "skc", "tag_code", "tag_value"]
    parts = [
        keys.join(skc_tags, "skc"),
        keys.join(org_tags, "org"),
        keys.join(pair_tags, ["org", "skc"]),
    ]
    return parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns))


def tag_codes(tags: DataFrame) -> list[str]:
    """Distinct tag codes, sorted.  The codes become columns, so there are few of them."""
    return sorted(r.tag_code for r in tags.select("tag_code").distinct().collect())


def pivot_tags(tags: DataFrame, keys: Sequence[str], codes: Sequence[str] | None = None) -> DataFrame:
    """One column per tag code holding its greatest value.  Pass the codes if known: it saves a job."""
    codes = list(codes) if codes is not None else tag_codes(tags)
    wide = tags.groupBy(*keys).pivot("tag_code", codes).agg(F.max("tag_value"))
    return wide.select(*keys, *[F.col(f"`{c}`").alias(f"{c}{SUFFIX}") for c in codes])


def add_tags(
    df: DataFrame, skc_tags: DataFrame, org_tags: DataFrame, pair_tags: DataFrame, codes: Sequence[str] | None = None
) -> DataFrame:
    """Tag columns for rows with ``org`` and ``skc``: the same as joining the pivoted union.

    Each grain is pivoted where it is small and looked up, instead of multiplying every key by every tag first.
    A code present at several grains takes the greatest value, as the union would.
    """
    grains = ((skc_tags, ["skc"]), (org_tags, ["org"]), (pair_tags, ["org", "skc"]))
    per_grain = [tag_codes(tags) if codes is None else list(codes) for tags, _ in grains]
    result = df
    for i, ((tags, keys), present) in enumerate(zip(grains, per_grain)):
        wide = pivot_tags(tags, keys, present)
        result = result.join(wide.select(*keys, *[F.col(f"`{c}{SUFFIX}`").alias(f"_{i}_{c}") for c in present]), keys, "left")

    def merged(code: str):
        found = [F.col(f"`_{i}_{code}`") for i, present in enumerate(per_grain) if code in present]
        return (F.greatest(*found) if len(found) > 1 else found[0]).alias(f"{code}{SUFFIX}")

    return result.select(*df.columns, *[merged(c) for c in sorted({c for present in per_grain for c in present})])


def melt(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns to (name, value) rows; NULL values give no row."""
    keep = [F.col(k) for k in keys]
    values = None if columns is None else [F.col(c) for c in columns]
    return df.unpivot(keep, values, name, value).filter(F.col(value).isNotNull())
