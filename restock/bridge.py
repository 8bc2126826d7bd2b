"""The domain tables, derived from the star-schema tables the queries are given.

lineitem is the ledger: each line is a document line that moves stock of an article (brand) and size (type) from
the supplier's nation to the customer's nation.
"""

from __future__ import annotations

from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.functions import columns as C
from restock.functions.columns import LABEL_CODE, LABEL_SOURCE
from restock.operators.deltas import Aggregates
from restock.session import stage

# Fixed values of the derived data set.
AS_OF = "1998-07-01"  # day the sales windows end at
CHANGED_SINCE = "2001-07-29"
RUN_DAY = "2001-08-01"  # older documents are planned together on this day
LIVE_FEED_REGIONS = ("AFRICA", "ASIA", "EUROPE")
WAREHOUSE_REGIONS = ("MIDDLE EAST",)
UPDATED_REGIONS = ("AMERICA", "ASIA", "EUROPE")
CLOSED_ORGS = ("NATION_24",)
SECOND_UNIT_REGIONS = ("EUROPE", "MIDDLE EAST")
SECOND_UNIT_SIZE = 48  # the second unit carries the brands with a part of this size or more
UNITS = {"U": ("WORLD", "World"), "V": ("WORLD-V", "World V")}
FEED_SCENE = "FURNITURE"

LEVEL_NAMES = {"operating_unit": "UNIT", "region": "REGION", "store": "STORE"}
TRANSFER_LEVELS = {"1-URGENT": ["region"], "2-HIGH": ["store"], "3-MEDIUM": ["store", "region"]}

# Schemas of the tables read here; with them a read needs no job to look into the files first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

STOCK_BASES = ["before_stock", "before_onroad_stock", "before_sub_stock", "before_include_stock"]


def _text(c: str) -> Column:
    return F.col(c).cast("string")


class Tables:
    """Lazy views over one data folder.  Nothing is read until a view is used."""

    def __init__(self, spark: SparkSession, folder: str, since: str = CHANGED_SINCE, run_day: str = RUN_DAY):
        """``since`` is the first day whose documents may still be changed, ``run_day`` the day on which older ones are planned."""
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.since, self.run_day = since, run_day

    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.raw("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    # --- documents ---------------------------------------------------------------------------------

    def _document_lines(self, lineitem: DataFrame, orders: DataFrame) -> DataFrame:
        qty = F.col("l_quantity").cast("bigint")
        # Customers join the orders, so that where tables are shuffled the lines are not for them.
        ordered = orders.join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return (
            lineitem.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.concat_ws("-", _text("l_orderkey"), "p_brand", _text("s_nationkey")).alias("doc"),
                _text("s_nationkey").alias("out_org"),
                _text("c_nationkey").alias("in_org"),
                _text("s_nationkey").alias("model_out_org"),
                F.when(F.col("l_linestatus") != "F", _text("c_nationkey")).alias("model_in_org"),
                F.col("p_brand").alias("skc"),
                F.col("p_type").alias("size"),
                F.concat_ws("|", "p_brand", "p_type").alias("sku"),
                qty.alias("model_qty"),
                F.when(F.col("l_returnflag") == "R", F.lit(0).cast("bigint")).otherwise(qty).alias("human_qty"),
                F.col("o_orderpriority").alias("template"),
                F.year("o_orderdate").alias("batch"),
                F.when(F.col("o_orderstatus") == "F", "0")
                .when(F.col("o_orderstatus") == "O", "1")
                .otherwise("2")
                .alias("source"),
                F.col("c_mktsegment").alias("scene"),
                self._status.alias("status"),
                F.col("o_orderdate").cast("date").alias("day"),
                F.greatest(F.col("o_orderdate").cast("date"), F.lit(self.run_day).cast("date")).alias("run_day"),
                F.when((F.col("l_tax") == 0) & (F.col("l_discount") == 0), "1").otherwise("0").alias("is_deleted"),
                F.when(F.col("l_returnflag") == "R", "")
                .when(F.col("l_returnflag") == "A", "None")
                .otherwise(F.concat(F.lit("P"), _text("l_orderkey")))
                .alias("plan_id"),
                F.when(F.col("l_linestatus") == "O", F.concat(F.lit("C"), _text("o_custkey"))).alias("collection_id"),
                F.when(qty >= 34, "1").when(qty >= 17, "2").when(qty >= 5, "3").otherwise("9").alias("level_code"),
            )
        )

    @property
    def _status(self) -> Column:
        recent = F.col("o_orderdate") >= F.lit(self.since).cast("timestamp_ntz")
        changed = F.when(F.col("l_returnflag") == "N", "1").when(F.col("l_returnflag") == "A", "2").otherwise("3")
        return F.when(~recent, "0").otherwise(changed)

    @property
    def _recent_orders(self) -> DataFrame:
        return self.raw("orders").filter(F.col("o_orderdate") >= F.lit(self.since).cast("timestamp_ntz"))

    def plan_lines(self, recent: bool = False) -> DataFrame:
        """Lines in force with their planning columns only, for what needs no org and no article."""
        orders = self._recent_orders if recent else self.raw("orders")
        return self._live_lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self._status.alias("status"), F.col("o_orderpriority").alias("template"), F.year("o_orderdate").alias("batch")
        )

    @cached_property
    def run_lines(self) -> DataFrame:
        """Lines in force of the recent days, each planned on its own day."""
        return self.recent_moves.withColumn("run_day", F.col("day"))

    @cached_property
    def document_lines(self) -> DataFrame:
        """All document lines, soft-deleted ones included."""
        return self._document_lines(self.lineitem, self.raw("orders"))

    # The views below filter the raw columns, so that the filters reach the file scans.

    @cached_property
    def _live_lineitem(self) -> DataFrame:
        tax, discount = F.col("l_tax"), F.col("l_discount")
        return self.lineitem.filter((tax != 0) | (discount != 0) | tax.isNull() | discount.isNull())

    @cached_property
    def moves(self) -> DataFrame:
        """Document lines in force."""
        return self._document_lines(self._live_lineitem, self.raw("orders"))

    @cached_property
    def recent_moves(self) -> DataFrame:
        """Lines in force of the days in which documents may still be changed."""
        return self._document_lines(self._live_lineitem, self._recent_orders)

    def lines_of_day(self, day: str) -> DataFrame:
        """All lines of one day, soft-deleted ones included."""
        start = F.lit(day).cast("timestamp_ntz")
        on_day = (F.col("o_orderdate") >= start) & (F.col("o_orderdate") < F.lit(day).cast("date") + 1)
        return self._document_lines(self.lineitem, self.raw("orders").filter(on_day))

    # --- dimensions --------------------------------------------------------------------------------

    @cached_property
    def part_classes(self) -> DataFrame:
        """Each part with its class path of one to five levels, and the parallel path of level types."""
        depth = (
            F.when(F.col("p_size") <= 1, 1)
            .when(F.col("p_size") <= 16, 2)
            .when(F.col("p_size") <= 33, 3)
            .when(F.col("p_size") <= 48, 4)
            .otherwise(5)
        )
        levels = F.array("p_type", "p_brand", _text("p_size"), "p_name", _text("p_partkey"))
        kinds = F.array(*[F.lit(k) for k in ("TYPE", "BRAND", "SIZE", "NAME", "PART")])
        return self.raw("part").select(
            "*",
            F.array_join(F.slice(levels, F.lit(1), depth), ":").alias("class_codes"),
            F.array_join(F.slice(kinds, F.lit(1), depth), ":").alias("class_types"),
        )

    @cached_property
    def dim_skc(self) -> DataFrame:
        """One row per article: the attributes of its oldest part."""
        first = F.min_by(
            F.struct("p_partkey", "p_size", "p_name", "p_type", "class_codes", "class_types"), F.col("p_partkey")
        )
        return (
            self.part_classes.groupBy(F.col("p_brand").alias("skc"))
            .agg(first.alias("p"))
            .select(
                "skc",
                F.col("p.p_size").cast("string").alias("suit"),
                F.col("p.p_name").alias("spu"),
                F.col("p.p_type").alias("color"),
                F.col("p.class_codes").alias("class_codes"),
                F.col("p.class_types").alias("class_types"),
            )
        )

    @cached_property
    def dim_sku(self) -> DataFrame:
        skus = self.raw("part").select(F.col("p_brand").alias("skc"), F.col("p_type").alias("size")).distinct()
        return skus.join(self.dim_skc.select("skc", "suit", "spu"), "skc").select(
            F.concat_ws("|", "skc", "size").alias("sku"), "skc", "size", "suit", "spu"
        )

    @cached_property
    def dim_org(self) -> DataFrame:
        """Stores and warehouses (nations), their regions and the operating unit, with parallel paths."""
        nation = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        region_sk = F.concat(F.lit("R"), _text("r_regionkey"))

        def unit(first: str, second: str) -> Column:
            return F.when(F.col("r_name").isin(*SECOND_UNIT_REGIONS), second).otherwise(first)

        key, code, name = (unit(u, v) for u, v in zip(("U", *UNITS["U"]), ("V", *UNITS["V"]), strict=True))
        stores = nation.select(
            _text("n_nationkey").alias("org"),
            region_sk.alias("parent"),
            F.col("n_name").alias("org_code"),
            F.concat(F.lit("Store "), F.col("n_name")).alias("org_name"),
            F.lit(2).alias("org_type"),
            F.when(F.col("r_name").isin(*WAREHOUSE_REGIONS), C.WAREHOUSE_FLAG).otherwise("1").alias("org_flag"),
            F.when(F.col("n_name").isin(*CLOSED_ORGS), "关闭").otherwise(C.OPEN_STATUS).alias("status"),
            F.lit("UNIT:REGION:STORE").alias("path_levels"),
            F.concat_ws(":", key, region_sk, _text("n_nationkey")).alias("path_keys"),
            F.concat_ws(":", code, "r_name", "n_name").alias("path_codes"),
            F.concat_ws(":", name, F.concat(F.lit("Region "), "r_name"), F.concat(F.lit("Store "), "n_name"))
            .alias("path_names"),
            F.concat(F.lit("Manager "), _text("n_nationkey")).alias("store_manager"),
            F.col("r_name").alias("region"),
        )
        regions = self.raw("region").select(
            region_sk.alias("org"),
            key.alias("parent"),
            F.col("r_name").alias("org_code"),
            F.concat(F.lit("Region "), "r_name").alias("org_name"),
            F.lit(1).alias("org_type"),
            F.lit(None).cast("string").alias("org_flag"),
            F.lit(C.OPEN_STATUS).alias("status"),
            F.lit("UNIT:REGION").alias("path_levels"),
            F.concat_ws(":", key, region_sk).alias("path_keys"),
            F.concat_ws(":", code, "r_name").alias("path_codes"),
            F.concat_ws(":", name, F.concat(F.lit("Region "), "r_name")).alias("path_names"),
            F.lit(None).cast("string").alias("store_manager"),
            F.col("r_name").alias("region"),
        )
        return stores.unionByName(regions).withColumn("unit", F.split_part("path_keys", F.lit(":"), F.lit(1)))

    @cached_property
    def brand_mapping(self) -> DataFrame:
        """Brands an operating unit carries: the first all of them, the second those that come in large sizes."""
        brands = self.raw("part").groupBy(F.col("p_brand").alias("brand")).agg(F.max("p_size").alias("largest"))
        units = F.array(F.lit("U"), F.when(F.col("largest") >= SECOND_UNIT_SIZE, "V"))
        return brands.select(F.explode(units).alias("unit"), "brand").filter(F.col("unit").isNotNull())

    @cached_property
    def updated_orgs(self) -> DataFrame:
        return self.dim_org.filter((F.col("org_type") == 2) & F.col("region").isin(*UPDATED_REGIONS)).select("org")

    @cached_property
    def templates(self) -> DataFrame:
        """Planning templates; every operating unit has all of them."""
        names = self.raw("orders").select(F.col("o_orderpriority").alias("template")).distinct()
        return names.withColumn("unit", F.explode(F.array(*[F.lit(u) for u in UNITS])))

    @cached_property
    def parameter_values(self) -> DataFrame:
        """JSON settings of the templates that have any; a template may have several."""
        settings = F.create_map(
            *[x for t, ls in TRANSFER_LEVELS.items() for x in (F.lit(t), F.array(*[F.lit(v) for v in ls]))]
        )
        return self.templates.select(
            "template", "unit", F.explode(F.try_element_at(settings, F.col("template"))).alias("level")
        ).select(
            "template",
            "unit",
            F.lit(C.TRANSFER_LEVEL_PARAMETER).alias("parameter_code"),
            F.to_json(F.struct(F.col("level").alias(C.TRANSFER_LEVEL_PARAMETER))).alias("parameter_value"),
        )

    @cached_property
    def level_names(self) -> DataFrame:
        return self.spark.createDataFrame(pa.table({"level": list(LEVEL_NAMES), "level_name": list(LEVEL_NAMES.values())}))

    # --- facts by (org, sku) -----------------------------------------------------------------------

    @cached_property
    def _ledger(self) -> DataFrame:
        return (
            self.lineitem.join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("order"),
                _text("s_nationkey").alias("org"),
                F.concat_ws("|", "p_brand", "p_type").alias("sku"),
                F.col("p_brand").alias("skc"),
                F.col("p_type").alias("size"),
                F.col("l_quantity").cast("bigint").alias("qty"),
                F.col("l_shipdate").cast("date").alias("ship_day"),
                "l_returnflag",
                "l_linestatus",
                "l_discount",
                "l_tax",
            )
        )

    @cached_property
    def ledger_rows(self) -> DataFrame:
        return self._ledger.withColumn("year", F.year("ship_day"))

    @property
    def cell_shape(self) -> Aggregates:
        """What all that stock, sales, targets, scores and bands need of the ledger, per (org, sku, year, open or closed)."""
        day, flag, qty = F.col("ship_day"), F.col("l_returnflag"), F.col("qty")
        as_of = F.lit(AS_OF).cast("date")

        def part(condition: Column) -> Column:
            return F.when(condition, qty).otherwise(0)

        def weighted(c: str) -> Column:
            return F.col(c).cast("decimal(4,2)") * qty.cast("decimal(9,0)")

        sums = {
            "qty": part(F.lit(True)),
            "qty_r": part(flag == "R"),
            "qty_n": part(flag == "N"),
            "qty_not_n": part(flag != "N"),
            "qty_a": part(flag == "A"),
            "kept": F.when(flag == "R", F.lit(0).cast("bigint")).otherwise(qty),
            "q7": part((day < as_of) & (day >= F.date_sub(as_of, 7))),
            "q14": part((day < F.date_sub(as_of, 7)) & (day >= F.date_sub(as_of, 14))),
            "qt": part(day < as_of),
            "discounted": weighted("l_discount"),
            "taxed": weighted("l_tax"),
        }
        return Aggregates(("org", "sku", "skc", "size", "year", "l_linestatus"), sums, {"first_day": day}, {"last_flag": flag})

    def cells_of(self, groups: DataFrame) -> DataFrame:
        """The cells from the aggregates, computed now or kept up to date in a store."""
        weights = {c: F.col(c).cast("decimal(20,2)") for c in ("discounted", "taxed")}
        return groups.select(*[weights.get(n, F.col(n)).alias(n) for n in self.cell_shape.names])

    @cached_property
    def cells(self) -> DataFrame:
        """The ledger summed per (org, sku, year, open or closed).  May be set to cells that were kept up to date."""
        return self.cells_of(self.cell_shape.full(self.ledger_rows))

    def settle(self) -> None:
        """Write the cells, so that all views of them share one pass over the ledger."""
        self.cells = stage(self.cells, "cells")

    @staticmethod
    def _stock_sums(cells: DataFrame) -> DataFrame:
        """Opening, on-road, on-order and committed quantities per (org, sku), then the stock figures from them."""
        year = F.col("year")

        def total(c: str, condition: Column) -> Column:
            return F.sum(F.when(condition, F.col(c)).otherwise(0))

        sums = cells.groupBy("org", "sku", "skc", "size").agg(
            total("qty", year < 1997).alias("opening"),
            total("qty_r", year < 1997).alias("returned"),
            total("qty", year == 1997).alias("onroad_stock"),
            total("qty_n", year == 1998).alias("onorder_in_stock"),
            total("qty_not_n", year == 1998).alias("onorder_out_stock"),
            total("qty_a", year == 1998).alias("committed_out"),
            *[F.sum(c).alias(c) for c in ("q7", "q14", "qt")],
            F.min("first_day").alias("first_day"),
        )
        after = F.col("opening") - F.col("returned")
        pending = F.col("onroad_stock") + F.col("onorder_in_stock") - F.col("onorder_out_stock")
        return sums.select(
            "org", "sku", "skc", "size", "q7", "q14", "qt", "first_day",
            F.col("opening").alias("before_stock"),
            (F.col("opening") + F.col("onroad_stock")).alias("before_onroad_stock"),
            (F.col("opening") - F.col("onorder_out_stock")).alias("before_sub_stock"),
            (F.col("opening") + pending).alias("before_include_stock"),
            after.alias("after_model_stock"),
            (after - F.col("onorder_out_stock")).alias("after_sub_stock"),
            (after + pending).alias("after_model_include_stock"),
            (after - F.col("committed_out")).alias("after_wh_sub_stock"),
            "onroad_stock", "onorder_in_stock", "onorder_out_stock", "committed_out",
            (F.col("opening") + F.col("onroad_stock") - F.col("committed_out")).alias("forecast_stock"),
        )

    @cached_property
    def sku_org(self) -> DataFrame:
        """Batch sales and stock figures per (org, sku)."""
        level = F.when(F.col("qt") >= 300, "1").when(F.col("qt") >= 100, "2").otherwise("3")
        return self._stock_sums(self.cells).withColumn("level_code", level)

    @cached_property
    def sku_org_live(self) -> DataFrame:
        """Real-time twins, for orgs with a live feed and articles with open lines only."""
        fed = self.dim_org.filter(F.col("region").isin(*LIVE_FEED_REGIONS)).select("org")
        open_cells = self.cells.filter(F.col("l_linestatus") == "O").join(fed, "org", "left_semi")
        return self._stock_sums(open_cells).drop("q7", "q14", "qt", "first_day")

    @cached_property
    def sales(self) -> DataFrame:
        return self.sku_org.select("org", "sku", "skc", "size", "q7", "q14", "qt")

    @cached_property
    def targets(self) -> DataFrame:
        """Target stock per (org, sku, batch): twice what was kept; 0 where all was returned, none where nothing moved."""
        by_batch = self.cells.groupBy("org", "sku", "skc", "size", F.col("year").alias("batch"))
        return by_batch.agg((F.sum("kept") * 2).alias("target"))

    @cached_property
    def scores(self) -> DataFrame:
        """Send and receive scores per (batch, skc, org), exact decimals with more than two places."""

        def raw(c: str) -> Column:
            return F.sum(c).cast("decimal(20,2)") * F.lit("0.137").cast("decimal(4,3)")

        return self.cells.groupBy(F.col("year").alias("batch"), "skc", "org").agg(
            raw("discounted").alias("send_score"), raw("taxed").alias("receive_score")
        )

    @cached_property
    def earlier(self) -> DataFrame:
        """Sizes of the earlier result: quantities stored per (org, skc, template, batch)."""
        return self.moves.groupBy(F.col("out_org").alias("org"), "skc", "size", "template", "batch").agg(
            F.sum("model_qty").alias("before_qty"), F.sum("human_qty").alias("after_qty")
        )

    # --- tags, labels ------------------------------------------------------------------------------

    @cached_property
    def skc_tags(self) -> DataFrame:
        return self.raw("part").groupBy(F.col("p_brand").alias("skc")).agg(
            F.lit("max_size").alias("tag_code"), F.max("p_size").cast("string").alias("tag_value")
        )

    @cached_property
    def org_tags(self) -> DataFrame:
        return self.dim_org.filter(F.col("org_type") == 2).select(
            "org", F.lit("region").alias("tag_code"), F.col("region").alias("tag_value")
        )

    @cached_property
    def org_skc_tags(self) -> DataFrame:
        return self.cells.groupBy("org", "skc").agg(F.lit("return_flag").alias("tag_code"), F.max("last_flag").alias("tag_value"))

    @cached_property
    def labels_spu(self) -> DataFrame:
        """Product labels from two sources; only one source and code is shown on documents."""
        by_name = self.raw("part").groupBy(F.col("p_name").alias("spu"))
        shown = by_name.agg(F.max("p_type").alias("label_value")).select(
            "spu", F.lit(LABEL_SOURCE).alias("label_source"), F.lit(LABEL_CODE).alias("label_code"), "label_value"
        )
        other = by_name.agg(F.min("p_brand").alias("label_value")).select(
            "spu", F.lit("02").alias("label_source"), F.lit(LABEL_CODE).alias("label_code"), "label_value"
        )
        return shown.unionByName(other)

    @cached_property
    def life_cycle(self) -> DataFrame:
        """Band of an article in an org: the quarter of its first line there."""
        return self.cells.groupBy("org", "skc").agg(F.min("first_day").alias("d")).select(
            "org", "skc", F.concat(F.year("d").cast("string"), F.lit("Q"), F.quarter("d").cast("string")).alias("band")
        )
