"""Which region manages an org, per planning template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.functions import columns as C


def transfer_levels(templates: DataFrame, settings: DataFrame) -> DataFrame:
    """Transfer level of each template: the lowest one set, or the default."""
    level = C.json_setting("parameter_value", C.TRANSFER_LEVEL_PARAMETER)
    configured = settings.filter(F.col("parameter_code") == C.TRANSFER_LEVEL_PARAMETER).select(
        "template", "unit", level.alias("level")
    )
    blank = templates.select("template", "unit", F.lit(None).cast("string").alias("level")).distinct()
    return (
        configured.unionByName(blank)
        .groupBy("template", "unit")
        .agg(F.coalesce(F.min("level"), F.lit(C.DEFAULT_TRANSFER_LEVEL)).alias("level"))
    )


def open_stores(orgs: DataFrame) -> DataFrame:
    return orgs.filter((F.col("org_type") == 2) & (F.col("status") == C.OPEN_STATUS))


def orgs_by_template(orgs: DataFrame, levels: DataFrame, level_names: DataFrame) -> DataFrame:
    """Open stores and warehouses with every template of their operating unit and the name of its level."""
    return open_stores(orgs).join(levels.join(level_names, "level"), "unit")


def with_parent(orgs: DataFrame, all_orgs: DataFrame) -> DataFrame:
    parents = all_orgs.select(
        F.col("org").alias("parent"), F.col("org_code").alias("parent_code"), F.col("org_name").alias("parent_name")
    )
    return orgs.join(parents, "parent", "left")


def managers(orgs: DataFrame, levels: DataFrame, level_names: DataFrame) -> DataFrame:
    """Manager of each open org under each template.

    A warehouse is managed by its parent, a store by the org at the template's level of its path.
    """
    rows = with_parent(orgs_by_template(orgs, levels, level_names), orgs)
    warehouse = F.col("org_flag") == C.WAREHOUSE_FLAG

    def manager(parent: str, path: str):
        return F.when(warehouse, F.col(parent)).otherwise(C.at_level("path_levels", path, "level_name"))

    return rows.select(
        "org",
        "template",
        "level",
        "org_code",
        "org_name",
        "org_flag",
        manager("parent", "path_keys").alias("manager_org"),
        manager("parent_code", "path_codes").alias("manager_code"),
        manager("parent_name", "path_names").alias("manager_name"),
        F.when(~warehouse, F.col("store_manager")).alias("store_manager"),
    ).distinct()


def org_info(orgs: DataFrame, brand_mapping: DataFrame) -> DataFrame:
    """Open orgs with their parent, a row for each brand of their unit; orgs without a parent are left out."""
    parents = orgs.select(
        F.col("org").alias("parent"), F.col("org_code").alias("manager_code"), F.col("org_name").alias("manager_name")
    )
    return (
        open_stores(orgs)
        .join(parents, "parent")
        .join(brand_mapping, "unit")
        .select("org", "org_code", "org_name", "manager_code", "manager_name", "org_flag", "store_manager", "brand")
        .distinct()
    )
