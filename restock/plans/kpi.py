"""KPI wide table: facts of updated orgs joined with their dimensions and one column per tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.operators import tags as T
from restock.operators.orgs import transfer_levels
from restock.session import stage, together

STAR = [
    "org", "sku", "skc", "step", "level", "size", "suit", "spu", "org_name", "region", "org_flag",
    "model_qty", "human_qty", "line_count", "send_package", "receive_package", "target_qty",
    "q7", "q14", "qt", "tag_price",
]


def _org_cells(t) -> DataFrame:
    """Quantities sent and received per (org, sku, step) of the updated orgs, from one pass over the moves."""
    nothing = F.lit(0).cast("bigint")
    sent = F.struct(
        F.col("out_org").alias("org"), "model_qty", "human_qty", F.lit(1).alias("line"), nothing.alias("received")
    )
    received = F.struct(
        F.col("in_org").alias("org"), nothing.alias("model_qty"), nothing.alias("human_qty"), F.lit(0).alias("line"),
        F.col("human_qty").alias("received"),
    )
    sides = t.moves.select(F.inline(F.array(sent, received)), "sku", "skc", F.col("template").alias("step"))
    return (
        sides.join(t.updated_orgs, "org", "left_semi")
        .groupBy("org", "sku", "skc", "step")
        .agg(
            F.sum("model_qty").alias("model_qty"),
            F.sum("human_qty").alias("human_qty"),
            F.sum("line").alias("line_count"),
            F.sum("received").alias("received"),
        )
    )


def star_join(t) -> DataFrame:
    """Moves, packages, targets and sales per (org, sku, step) with org, article and step attributes.

    The org filter comes first, so the facts are cut before they are aggregated and joined.
    """
    t.settle()
    cells = stage(_org_cells(t), "org-cells")
    per_sku = cells.filter(F.col("line_count") > 0).drop("received")
    packages = cells.groupBy("org", "step").agg(
        F.sum("model_qty").alias("send_package"), F.sum("received").alias("receive_package")
    )
    updated = t.updated_orgs  # these joins go below the aggregates
    targets = t.targets.join(updated, "org", "left_semi").groupBy("org", "sku").agg(F.sum("target").alias("target_qty"))
    steps = transfer_levels(t.templates, t.parameter_values).select(F.col("template").alias("step"), "unit", "level")
    orgs = t.dim_org.filter(F.col("org_type") == 2).select("org", "unit", "org_name", "region", "org_flag")
    prices = t.raw("part").groupBy(F.concat_ws("|", "p_brand", "p_type").alias("sku")).agg(
        F.max("p_retailprice").alias("tag_price")
    )
    return (
        per_sku.join(packages, ["org", "step"])
        .join(targets, ["org", "sku"])
        .join(t.sales.join(updated, "org", "left_semi").select("org", "sku", "q7", "q14", "qt"), ["org", "sku"])
        .join(orgs, "org")
        .join(steps, ["step", "unit"])
        .join(t.dim_sku.select("sku", "size", "suit", "spu"), "sku")
        .join(prices, "sku")
        .select(*STAR)
    )


def tag_union(t) -> DataFrame:
    """All tags of the (org, skc) pairs with moves out."""
    keys = t.moves.select(F.col("out_org").alias("org"), "skc").distinct()
    return T.union_tags(keys, t.skc_tags, t.org_tags, t.org_skc_tags)


def wide_table(t, codes: Sequence[str] | None = None) -> DataFrame:
    """Star rows with a column per tag code; rows without a tag keep NULL."""
    star, skc_tags, org_tags, pair_tags = together(
        t.spark,
        lambda: star_join(t),
        lambda: stage(t.skc_tags, "skc-tags"),
        lambda: stage(t.org_tags, "org-tags"),
        lambda: stage(t.org_skc_tags, "pair-tags"),
    )
    return T.add_tags(star, skc_tags, org_tags, pair_tags, codes)
