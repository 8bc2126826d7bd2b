"""The query catalogue: name → function of (session, data folder) giving a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from restock import bridge as B
from restock.bridge import STOCK_BASES as BASES
from restock.bridge import Tables
from restock.functions import bundles as BU
from restock.functions import columns as C
from restock.operators import changes as CH
from restock.operators import deltas
from restock.operators import documents as D
from restock.operators import keysets as K
from restock.operators import lookups as L
from restock.operators import orgs as O
from restock.operators import runs as R
from restock.operators import sales as S
from restock.operators import stock as ST
from restock.operators import tags as T
from restock.operators import upserts as U
from restock.plans import daily, kpi, publish
from restock.plans.detail import DETAIL, ENRICHED, SCORES, Detail, earlier_bundles
from restock.session import configure, stage, work_path
from restock.sources import external as EX
from restock.sources import replicate as RP
from restock.sources import tables as TB
from restock.sources.keyed import KeyedStore
from restock.sources.store import Store
from restock.streaming.replica import Replica

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

# Parameters of single queries.
SLICE_DAY = "1998-07-01"
SYNC_BATCHES = (1996, 1998)
SYNC_MONTH = "1998-07-01"
SYNC_LINES = (1, 2)
RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
SYNC_DENY = ("benchmark", "labels")


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the derived tables under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Tables(configure(spark), folder))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    CATALOGUE[function.__name__] = run
    return function


def _day_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _skus(t: Tables) -> DataFrame:
    return stage(t.dim_sku, "dim-sku")


def _managers(t: Tables) -> DataFrame:
    return stage(O.managers(t.dim_org, O.transfer_levels(t.templates, t.parameter_values), t.level_names), "managers")


# --- sources and sinks -------------------------------------------------------------------------------

LINE = ["doc", "out_org", "in_org", "sku", "model_qty", "human_qty", "template", "batch", "source", "status"]


@query
def scan_day_slice(t: Tables) -> DataFrame:
    return TB.day_slice(t.lines_of_day(SLICE_DAY), SLICE_DAY).select(*LINE)


@query
def scan_parquet_view(t: Tables) -> DataFrame:
    TB.parquet_view(t.spark, f"{t.folder}/part.parquet", "part_view")
    return t.spark.sql("SELECT * FROM part_view")


@query
def parquet_roundtrip(t: Tables) -> DataFrame:
    joined = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select("o_orderkey", "c_name", "c_mktsegment", F.col("o_totalprice").alias("total"))
    exported = TB.write_parquet(rows, work_path(t.spark, "export"))
    loaded = work_path(t.spark, "loaded")
    TB.append_files(exported, loaded, rows.columns)
    return t.spark.read.schema(rows.schema).parquet(loaded)


@query
def csv_roundtrip(t: Tables) -> DataFrame:
    part, path = t.raw("part"), work_path(t.spark, "csv")
    TB.write_csv(part, path)
    return TB.read_csv(t.spark, path, part.schema)


@query
def append_by_name(t: Tables) -> DataFrame:
    """A stored table to which later orders are appended, their columns in another order."""
    orders = t.raw("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    old = F.col("o_orderdate") < "1999"
    target = Store(t.spark, work_path(t.spark, "orders"), orders.schema).replace(orders.filter(old))
    return target.append(orders.filter(~old).select(*reversed(orders.columns))).current()


def _old_target(rows: DataFrame, partition: str | None = None) -> Store:
    """A target that has drifted: every price is 0."""
    target = Store(rows.sparkSession, work_path(rows.sparkSession, "target"), rows.schema, partition)
    return target.replace(rows.withColumn("total", F.lit(0.0)))


@query
def sync_full(t: Tables) -> DataFrame:
    source = t.raw("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("total"))
    target = _old_target(source)
    RP.sync_full(source, target)
    return target.current()


@query
def sync_batches(t: Tables) -> DataFrame:
    source = t.raw("orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("total"), F.year("o_orderdate").alias("batch_id")
    )
    target = _old_target(source, "batch_id")
    RP.sync_batches(source, target, SYNC_BATCHES)
    return target.current()


@query
def sync_day(t: Tables) -> DataFrame:
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    source = t.raw("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("total"), month.alias("day_date"))
    target = _old_target(source, "day_date")
    RP.sync_day(source, target, SYNC_MONTH)
    return _day_text(target.current(), "day_date")


@query
def sync_changed(t: Tables) -> DataFrame:
    """Copy of the years that differ: two with drifted prices, one that lacks orders, one that is not there, one too many."""
    source = t.raw("orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("total"), F.year("o_orderdate").alias("batch_id")
    )
    year = F.col("batch_id")
    drifted = source.filter((year != 1999) & ~((year == 1997) & (F.col("o_orderkey") % 7 == 0)))
    drifted = drifted.withColumn("total", F.when(year.isin(*SYNC_BATCHES) & (F.col("o_orderkey") % 3 == 0), 0.0).otherwise(F.col("total")))
    extra = source.filter(year == 1998).withColumn("batch_id", F.lit(1900))
    target = Store(t.spark, work_path(t.spark, "target"), source.schema, "batch_id").replace(drifted.unionByName(extra))
    copied = RP.sync_changed(source, target)
    RP.sync_changed(source, target)
    return target.current().join(copied, "batch_id", "full")


@query
def sync_keys(t: Tables) -> DataFrame:
    """Copy of the orders that differ: some have another price, some are missing, some are too many."""
    source = t.raw("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("total"))
    key = F.col("o_orderkey")
    drifted = source.filter(key % 101 != 0).withColumn("total", F.when(key % 103 == 0, -1.0).otherwise(F.col("total")))
    extra = source.filter((key % 107 == 0) & (key > 0)).withColumn("o_orderkey", -key)
    target = KeyedStore(t.spark, work_path(t.spark, "target"), source.schema, "o_orderkey").replace(drifted.unionByName(extra))
    copied = RP.sync_keys(source, target)
    return target.current().join(copied, "o_orderkey", "full")


@query
def sync_catalog_plan(t: Tables) -> DataFrame:
    """Copy plan of the given tables with their row counts; lineitem has the integer batch column."""
    tables = {name: t.raw(name) for name in RAW_TABLES}
    plan = RP.sync_plan(RP.catalog_columns(tables, t.spark), SYNC_DENY, "l_linenumber")
    counts = None
    for name, df in tables.items():
        rows = df.agg(F.count("*").alias("n_rows")).withColumn("table", F.lit(name))
        counts = rows if counts is None else counts.unionByName(rows)
    return plan.join(counts, "table").orderBy("table")


@query
def sync_tables(t: Tables) -> DataFrame:
    """The plan carried out: all given tables copied, lineitem by some of its batches; rows and columns of the copies."""
    tables = {name: t.raw(name) for name in RAW_TABLES}
    plan = RP.sync_plan(RP.catalog_columns(tables, t.spark), SYNC_DENY, "l_linenumber")
    copies = RP.sync_tables(plan, tables, work_path(t.spark, "copies"), SYNC_LINES, "l_linenumber")
    counts = None
    for name, copy in copies.items():
        rows = copy.current().agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows", F.lit(len(copy.schema)).alias("n_columns"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


@query
def sink_distributed(t: Tables) -> DataFrame:
    """The wide table through the distributed sink; its decimals are shown as doubles."""
    stored = TB.write_distributed(kpi.wide_table(t), work_path(t.spark, "wide"), "skc")
    return _as_double(stored, "tag_price")


# --- projections and filters -------------------------------------------------------------------------


@query
def filter_changed_docs(t: Tables) -> DataFrame:
    return t.recent_moves.filter(C.is_changed("status")).select(*LINE)


@query
def drop_null_orgs(t: Tables) -> DataFrame:
    return t.moves.filter(F.col("model_in_org").isNotNull()).select("doc", "sku", "model_in_org", "model_qty")


@query
def filter_with_sales(t: Tables) -> DataFrame:
    return S.with_sales(t.sales)


@query
def decode_sales_level(t: Tables) -> DataFrame:
    return t.moves.select("doc", "sku", "level_code", C.sales_level_label("level_code").alias("level_name"))


@query
def conditional_expose(t: Tables) -> DataFrame:
    stores = t.dim_org.select(F.col("org").alias("out_org"), "org_flag", "store_manager")
    docs = t.moves.select("doc", "out_org").join(stores, "out_org", "left")
    return docs.select("doc", C.exposed_if("org_flag", "1", "store_manager").alias("manager"))


@query
def prefer_first_nonblank(t: Tables) -> DataFrame:
    value, label = C.first_non_blank({"plan_id": "plan_id", "collection_id": "collection_id"})
    return t.moves.select("doc", "sku", value.alias("origin_id"), label.alias("origin_kind"))


@query
def null_org_sentinel(t: Tables) -> DataFrame:
    return t.moves.select("doc", "sku", C.org_or_sentinel("model_in_org").alias("model_in_org"))


@query
def gate_has_changes(t: Tables) -> DataFrame:
    return K.has_changes(t.plan_lines(recent=True))


@query
def distinct_keys(t: Tables) -> DataFrame:
    return t.moves.select(F.col("out_org").alias("org"), "skc").distinct()


@query
def org_skc_union(t: Tables) -> DataFrame:
    return K.two_sided_keys(t.moves)


@query
def top_rows(t: Tables) -> DataFrame:
    per_doc = t.moves.groupBy("doc").agg(F.sum("model_qty").alias("qty"))
    return per_doc.orderBy(F.desc("qty"), F.asc("doc")).limit(10)


# --- joins -------------------------------------------------------------------------------------------


@query
def semi_skc(t: Tables) -> DataFrame:
    changed = t.recent_moves.filter(C.is_changed("status")).select("skc").distinct()
    return K.by_key_set(t.part_classes.withColumnRenamed("p_brand", "skc"), changed, ["skc"]).select(
        "p_partkey", "skc", "p_type"
    )


@query
def in_subquery(t: Tables) -> DataFrame:
    """All lines of documents that have a changed line."""
    return K.by_key_set(t.moves, publish.changed_documents(t.recent_moves), ["doc"]).select(*LINE)


@query
def filter_by_key_set(t: Tables) -> DataFrame:
    """Stock of changed (org, skc) pairs, with the number of changed lines of the pair."""
    changed = t.recent_moves.filter(C.is_changed("status")).groupBy(F.col("out_org").alias("org"), "skc").agg(
        F.count("*").alias("changed_lines")
    )
    stock = t.sku_org.select("org", "skc", "sku", "before_stock")
    return K.by_key_set(stock, changed, ["org", "skc"], ["changed_lines"])


@query
def affected_docs(t: Tables) -> DataFrame:
    return K.touching(t.moves, K.changed_pairs(t.recent_moves)).select(*LINE, "skc", "model_in_org")


@query
def store_c_anti(t: Tables) -> DataFrame:
    pairs = stage(K.changed_pairs(t.recent_moves), "changed")
    return K.unchanged_pairs(K.touching(t.moves.select(*K.ORG_ROLES, "skc"), pairs), pairs)


@query
def org_by_template(t: Tables) -> DataFrame:
    levels = O.transfer_levels(t.templates, t.parameter_values)
    return O.orgs_by_template(t.dim_org, levels, t.level_names).select("org", "template", "level", "level_name")


@query
def org_parent(t: Tables) -> DataFrame:
    return O.with_parent(t.dim_org, t.dim_org).select("org", "parent", "parent_code", "parent_name")


@query
def org_info(t: Tables) -> DataFrame:
    return O.org_info(t.dim_org, t.brand_mapping)


@query
def org_manager_path(t: Tables) -> DataFrame:
    return O.managers(t.dim_org, O.transfer_levels(t.templates, t.parameter_values), t.level_names)


@query
def resolve_params(t: Tables) -> DataFrame:
    return O.transfer_levels(t.templates, t.parameter_values).select("template", "unit", "level")


@query
def class_level(t: Tables) -> DataFrame:
    depth, code, label = C.class_level("class_codes", "class_types")
    return t.part_classes.select(
        "p_partkey", depth.alias("depth"), code.alias("level_code"), label.alias("class_label")
    )


@query
def complete_sizes(t: Tables) -> DataFrame:
    return L.complete_sizes(t.moves.select("doc", "skc").distinct(), _skus(t)).select("doc", "skc", "size")


@query
def complete_sizes_moves(t: Tables) -> DataFrame:
    return L.complete_sizes(K.two_sided_keys(t.moves), _skus(t)).select("org", "skc", "sku")


@query
def expand_templates(t: Tables) -> DataFrame:
    return _day_text(R.expand_runs(*_signed(t)).select("day", "org", "sku", "template", "batch"), "day")


@query
def two_sided_lookup(t: Tables) -> DataFrame:
    stock = stage(t.sku_org.groupBy("org", "skc").agg(F.sum("before_stock").alias("stock")), "stock")
    docs = D.headers(t.moves).select("doc", "skc", "out_org", "in_org")
    return L.side_lookup(docs, stock, D.SIDES, ["stock"], on=["skc"])


@query
def roleplay_orgs(t: Tables) -> DataFrame:
    orgs = t.dim_org.select("org", "org_code", "region")
    docs = D.headers(t.moves).select("doc", "out_org", "in_org", "model_out_org", "model_in_org")
    sides = {"human_out": "out_org", "human_in": "in_org", "model_out": "model_out_org", "model_in": "model_in_org"}
    return L.side_lookup(docs, orgs, sides, ["org_code", "region"])


@query
def join_filtered_right(t: Tables) -> DataFrame:
    parts = t.raw("part").select("p_partkey", F.col("p_name").alias("spu"))
    shown = (F.col("label_source") == B.LABEL_SOURCE) & (F.col("label_code") == B.LABEL_CODE)
    return L.filtered_lookup(parts, t.labels_spu, shown, ["spu"], ["label_value"])


# --- tags and the KPI wide table ---------------------------------------------------------------------


@query
def kpi_star_join(t: Tables) -> DataFrame:
    return kpi.star_join(t)


@query
def kpi_wide(t: Tables) -> DataFrame:
    return kpi.wide_table(t)


@query
def ctas_kpi_wide(t: Tables) -> DataFrame:
    path = work_path(t.spark, "ctas")
    return TB.create_table_as(kpi.wide_table(t), f"kpi_wide_{path[-12:]}", path)


@query
def union_tags(t: Tables) -> DataFrame:
    return kpi.tag_union(t)


@query
def pivot_tags(t: Tables) -> DataFrame:
    return T.pivot_tags(stage(kpi.tag_union(t), "tags"), ["org", "skc"])


@query
def unpivot_months(t: Tables) -> DataFrame:
    months = [f"m{m:02d}" for m in range(1, 13)]
    orders = t.raw("orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "'m'MM").alias("month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    wide = orders.groupBy("priority", "year").pivot("month", months).agg(F.sum("amount"))
    return _as_double(T.melt(wide, ["priority", "year"], "month", "sales"), "sales")


# --- documents ---------------------------------------------------------------------------------------


@query
def doc_header(t: Tables) -> DataFrame:
    return _day_text(D.headers(t.moves), "day", "run_day")


@query
def gs_doc_qty(t: Tables) -> DataFrame:
    return D.size_quantities(t.moves, _skus(t))


@query
def doc_qty_json(t: Tables) -> DataFrame:
    return D.quantity_bundles(t.moves, _skus(t))


@query
def min_json_bundle(t: Tables) -> DataFrame:
    return D.min_bundles(t.earlier)


@query
def latest_batch(t: Tables) -> DataFrame:
    return D.latest_batch(t.plan_lines())


@query
def batch_stock_lookup(t: Tables) -> DataFrame:
    docs = D.headers(t.moves).select("doc", "skc", "batch", "model_out_org", "model_in_org")
    return D.batch_stock(docs, stage(D.min_bundles(t.earlier), "stored"))


@query
def score_round(t: Tables) -> DataFrame:
    rounded = t.scores.select("batch", "skc", "org", C.score("send_score").alias("send_score"), C.score("receive_score").alias("receive_score"))
    return _as_double(rounded, "send_score", "receive_score")


@query
def priority_scores(t: Tables) -> DataFrame:
    docs = D.headers(t.moves).select("doc", "skc", "batch", "out_org", "in_org")
    scored = D.priority_scores(docs, stage(t.scores, "scores"))
    return _as_double(scored, "out_send_score", "out_receive_score", "in_send_score", "in_receive_score")


@query
def gs_target_stock(t: Tables) -> DataFrame:
    return D.target_stock(t.targets)


@query
def target_stock_json(t: Tables) -> DataFrame:
    return D.target_bundles(D.target_stock(t.targets))


@query
def fill_rate(t: Tables) -> DataFrame:
    docs = D.headers(t.moves).select("doc", "skc", "batch", "out_org", "in_org")
    rates = D.fill_rates(docs, stage(D.target_stock(t.targets), "target"), stage(D.stock_after_model(t.sku_org), "after"))
    return _as_double(rates, "out_fill", "in_fill")


# --- sales -------------------------------------------------------------------------------------------


@query
def gs_national_skc(t: Tables) -> DataFrame:
    return BU.with_totals(S.with_sales(t.sales), ["skc"], S.WINDOWS)


@query
def json_bundle(t: Tables) -> DataFrame:
    return BU.total_bundle(S.with_sales(t.sales), ["skc"], S.WINDOWS)


@query
def gs_region_skc(t: Tables) -> DataFrame:
    sold = S.with_manager(S.with_sales(t.sales), _managers(t))
    return BU.with_totals(sold, ["region", "template", "skc"], S.WINDOWS)


@query
def sales_by_org(t: Tables) -> DataFrame:
    return S.roll_up(S.with_sales(t.sales), ["org"])


@query
def sales_by_org_suit(t: Tables) -> DataFrame:
    return S.roll_up(S.with_product(S.with_sales(t.sales), _skus(t)), ["org", "suit"])


@query
def sales_by_org_spu(t: Tables) -> DataFrame:
    return S.roll_up(S.with_product(S.with_sales(t.sales), _skus(t)), ["org", "spu"])


@query
def sales_by_suit(t: Tables) -> DataFrame:
    return S.roll_up(S.with_product(S.with_sales(t.sales), _skus(t)), ["suit"])


@query
def sales_by_region_suit(t: Tables) -> DataFrame:
    sold = S.with_manager(S.with_product(S.with_sales(t.sales), _skus(t)), _managers(t))
    return S.roll_up(sold, ["region", "template", "suit"])


@query
def sales_rollups_long(t: Tables) -> DataFrame:
    return S.all_grains(stage(t.sales, "sales"), _skus(t), _managers(t))


# --- stock -------------------------------------------------------------------------------------------


def _matrix(t: Tables) -> DataFrame:
    keys = ST.stock_keys(t.moves, _skus(t), F.col("scene") == B.FEED_SCENE)
    return ST.source_matrix(keys, t.sku_org, t.sku_org_live)


@query
def stock_source_matrix(t: Tables) -> DataFrame:
    return _matrix(t).select(*ST.KEYS, "size", *ST.FIGURES)


@query
def stock_metrics(t: Tables) -> DataFrame:
    return ST.stock_metrics(_matrix(t))


@query
def stock_metrics_json(t: Tables) -> DataFrame:
    matrix = stage(_matrix(t), "matrix")
    bundles = ST.stock_bundles(matrix)
    return _day_text(bundles.join(ST.stock_attributes(matrix), ST.KEYS), "first_day")


# --- runs --------------------------------------------------------------------------------------------


@query
def template_order(t: Tables) -> DataFrame:
    return _day_text(R.run_order(t.run_lines), "day")


def _signed(t: Tables) -> tuple[DataFrame, DataFrame]:
    return R.signed_moves(t.run_lines), R.run_order(t.run_lines)


@query
def running_moves(t: Tables) -> DataFrame:
    return _day_text(R.running_moves(*_signed(t)), "day")


@query
def stock_before_after(t: Tables) -> DataFrame:
    signed, runs = _signed(t)
    return _day_text(R.before_after(stage(signed, "signed"), runs, _skus(t), t.sku_org, BASES), "day")


@query
def stock_before_after_json(t: Tables) -> DataFrame:
    signed, runs = _signed(t)
    rows = R.before_after(stage(signed, "signed"), runs, _skus(t), t.sku_org, BASES)
    return _day_text(R.before_after_bundles(rows, BASES), "day")


@query
def net_stock_after(t: Tables) -> DataFrame:
    signed = stage(R.signed_moves(t.run_lines), "signed")
    return _day_text(R.net_after(signed, _skus(t), t.sku_org, BASES), "day")


@query
def carry_over_store_c(t: Tables) -> DataFrame:
    """Stock after all runs of the affected documents; pairs that did not change themselves keep what the last run before stored."""
    true = stage(earlier_bundles(t.earlier), "true-figures")
    runs = {1: ("after_qty", "before_qty"), 2: ("before_qty", "after_qty"), 4: ("after_qty", "after_qty")}
    history = None
    for number, (before, after) in runs.items():
        rows = true.select("org", "skc", *R.RUN, F.col(before).alias("before_qty"), F.col(after).alias("after_qty"), F.lit(number).cast("bigint").alias("run"))
        history = rows if history is None else history.unionByName(rows)
    return Detail(t, history=stage(history, "history"), number=4).net_stock


@query
def cells_maintained(t: Tables) -> DataFrame:
    """The ledger's cells after orders have come, gone and changed, brought up to date by these orders alone."""
    rows, order = stage(t.ledger_rows, "ledger-rows"), F.col("order")
    changed = F.col("order") % 7 == 0
    was = rows.filter(order % 5 != 0).withColumn("qty", F.when(changed, F.col("qty") + 3).otherwise(F.col("qty")))
    was = was.withColumn("ship_day", F.when(changed, F.date_sub("ship_day", 4)).otherwise(F.col("ship_day"))).withColumn("year", F.year("ship_day"))
    was = was.withColumn("l_returnflag", F.when(changed, "R").otherwise(F.col("l_returnflag")))
    extra = rows.filter(order % 11 == 1).withColumn("order", -order)
    ledger = KeyedStore(t.spark, work_path(t.spark, "ledger"), rows.schema, "order").replace(was.unionByName(extra))
    cells = KeyedStore(t.spark, work_path(t.spark, "cells"), deltas.schema(t.cell_shape, rows), deltas.CELL)
    deltas.start(cells, t.cell_shape, ledger.current())
    seen = ledger.head()
    ledger.upsert(rows.filter((order % 5 == 0) | changed), extra.select("order"), seen)
    deltas.refresh(cells, t.cell_shape, *ledger.changes(seen), ledger.current())
    return _as_double(_day_text(t.cells_of(cells.current()), "first_day"), "discounted", "taxed")


# --- document detail ---------------------------------------------------------------------------------

@query
def doc_enrich(t: Tables) -> DataFrame:
    return Detail(t).enriched().select(*ENRICHED)


@query
def doc_detail(t: Tables) -> DataFrame:
    detail = Detail(t).result().select(*ENRICHED, *[c for c in DETAIL if c not in ENRICHED])
    return _as_double(_day_text(detail, "day", "out_first_day", "in_first_day"), *SCORES)


# --- stored results ----------------------------------------------------------------------------------


def _stored(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Earlier result rows: every document once, those with a returned line twice."""
    lines = t.moves if lines is None else lines
    returned = F.max(F.when(F.col("plan_id") == "", 2).otherwise(1))
    docs = lines.groupBy("doc", "batch").agg(F.sum("human_qty").alias("qty"), returned.alias("copies"))
    copies = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(F.concat_ws("#", "doc", "copy").alias("id"), "doc", "qty", "batch")


def _fresh(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Recomputed rows of the changed documents."""
    lines = t.moves if lines is None else lines
    changed = K.by_key_set(lines, publish.changed_documents(t.recent_moves), ["doc"])
    docs = changed.groupBy("doc", "batch").agg(F.sum("model_qty").alias("qty"))
    return docs.select(F.concat_ws("#", "doc", F.lit("new")).alias("id"), "doc", "qty", "batch")


@query
def dup_docs(t: Tables) -> DataFrame:
    return U.duplicates(_stored(t), "doc")


@query
def dedupe_orders(t: Tables) -> DataFrame:
    return U.keep_lowest_id(_stored(t), "doc")


@query
def replace_by_key(t: Tables) -> DataFrame:
    return U.replace_by_key(_stored(t), _fresh(t), ["doc"])


@query
def reset_status(t: Tables) -> DataFrame:
    lines = t.moves.select("doc", "sku", "status", "model_qty")
    return publish.reset_status(lines, publish.changed_documents(t.recent_moves))


@query
def listagg_roundtrip(t: Tables) -> DataFrame:
    changed = t.recent_moves.filter(C.is_changed("status"))
    return U.split_lists(U.joined_lists(changed, "out_org", "doc", lists=64), "out_org", "doc")


@query
def publish_incremental(t: Tables) -> DataFrame:
    lines = stage(t.moves.select("doc", "batch", "model_qty", "human_qty", "plan_id"), "lines")  # joined once for both
    stored = _stored(t, lines)
    results = KeyedStore(t.spark, work_path(t.spark, "published"), stored.schema, "doc").replace(stored)
    return publish.publish(results, _fresh(t, lines))


@query
def run_day(t: Tables) -> DataFrame:
    """A run from end to end, twice: the stored results afterwards, and how many lines still count as changed."""
    stored = t.moves.select(*daily.LINES.names)
    lines = KeyedStore(t.spark, work_path(t.spark, "lines"), daily.LINES, "doc", order=["run_day"]).replace(stored)
    old = D.headers(lines.current()).withColumn("id", F.concat_ws("#", "doc", F.lit("1")))  # joined once for both
    known = ("id", "doc", "batch", "skc", "out_org", "in_org")
    results = KeyedStore(t.spark, work_path(t.spark, "results"), daily.RESULT, "doc", order=["batch"]).replace(old, columns=known)
    daily.run(t, results, lines)
    daily.run(t, results, lines)
    left = lines.current().filter(C.is_changed("status")).groupBy("doc").agg(F.count("*").alias("changed_lines"))
    left = stage(left, "left")  # few, so that the wide rows are not shuffled for them
    shown = results.current().drop("run_day", "created_at", "updated_at").join(left, "doc", "left")
    shown = _as_double(_day_text(shown, "day", "out_first_day", "in_first_day"), *SCORES)
    return shown.withColumn("changed_lines", F.coalesce("changed_lines", F.lit(0)))


# --- change data capture -----------------------------------------------------------------------------

CDC_TABLE = "account"
CDC_COLUMNS = ["id", "value", "event_type", "k"]


def _envelopes(t: Tables) -> DataFrame:
    """Events as change messages.

    Names differ in case from the target, one field is unknown to it, clicks nest their data as text, and the old
    data is partly stale or missing.
    """
    kind, key = F.col("event_type"), F.col("user_id").cast("string")
    value = F.col("value").cast("decimal(12,2)").cast("string")
    # A file of events is small for the work that its rows make: they are spread first.
    e = t.events.repartition("event_id").select(
        "event_id", kind, key.alias("key"), value.alias("text"), F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("value") < 5, value).otherwise("0.00").alias("old_text"), _escaped("props").alias("extra"),
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("op"),
    )
    data = F.format_string(
        '{"ID":"%s","VALUE":"%s","Event_Type":"%s","k":"%s","extra":"%s"}', "key", "text", "event_type", "k", "extra"
    )
    e = e.withColumn("data", data)
    body = F.when(kind == "click", F.concat(F.lit('"'), _escaped("data"), F.lit('"'))).otherwise(F.col("data"))
    old = F.format_string(',"oldData":{"ID":"%s","VALUE":"%s","Event_Type":"view","k":"%s"}', "key", "old_text", "k")
    tail = F.when(kind.isin("view", "click"), old).otherwise("")
    head = F.format_string(f'{{"table":"{CDC_TABLE}","type":"%s","shardingKey":"%s","data":', "op", "key")
    return e.select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.concat(head, body, tail, F.lit("}")).alias("value"),
    )


def _escaped(c: str):
    """Text as it is written inside a JSON string."""
    return F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def _stored_accounts(t: Tables) -> DataFrame:
    """Rows present before the events: the suppliers.  Users beyond their numbers are not stored yet."""
    return t.raw("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_acctbal").alias("value"),
        F.col("s_name").alias("event_type"),
        F.lit(0).cast("bigint").alias("k"),
    )


def _checked(t: Tables, envelopes: DataFrame) -> DataFrame:
    return CH.checked(envelopes, CDC_TABLE, _stored_accounts(t).schema, "id")


def _events(t: Tables) -> DataFrame:
    return CH.accepted(_checked(t, _envelopes(t)))


def _damaged(t: Tables) -> DataFrame:
    """The messages with dear purchases cut off, small sign-ups without a number, and errors with a key of another kind."""
    e = t.events.select(F.col("event_id").alias("offset"), F.col("event_type").alias("kind"), F.col("value").alias("v"))
    text = F.col("value")
    text = (
        F.when((F.col("kind") == "purchase") & (F.col("v") > 30), F.substring(text, 1, 40))
        .when((F.col("kind") == "signup") & (F.col("v") < 5), F.regexp_replace(text, '"VALUE":"[^"]*"', '"VALUE":"n/a"'))
        .when((F.col("kind") == "error") & (F.col("v") > 20), F.regexp_replace(text, '"shardingKey":"', '"shardingKey":"x'))
        .otherwise(text)
    )
    return _envelopes(t).join(e, "offset").select("partition", "offset", text.alias("value"))


def _map_text(c: str):
    """A map as sorted text."""
    pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return F.array_join(pairs, ";").alias(c)


@query
def cdc_parse(t: Tables) -> DataFrame:
    parsed = CH.parse(_envelopes(t), CDC_TABLE)
    return parsed.select(F.col("seq.offset").alias("offset"), "key", "op", F.size("data").alias("n_fields"), F.col("data.VALUE").alias("value"))


@query
def cdc_normalise(t: Tables) -> DataFrame:
    rows = CH.normalise(CH.parse(_envelopes(t), CDC_TABLE), CDC_COLUMNS)
    return rows.select(F.col("seq.offset").alias("offset"), "key", "op", _map_text("data"))


@query
def cdc_changed_fields(t: Tables) -> DataFrame:
    return _events(t).select(F.col("seq.offset").alias("offset"), "key", "op", _map_text("changed"))


@query
def cdc_rejects(t: Tables) -> DataFrame:
    return CH.rejected(_checked(t, _damaged(t))).select("offset", "reason")


@query
def cdc_apply(t: Tables) -> DataFrame:
    return CH.apply(_stored_accounts(t), stage(_events(t), "events"), "id")


def _in_offset_order(messages: DataFrame, parts: int) -> list[DataFrame]:
    """Messages cut into parts by offset, as a queue would deliver them."""
    last = messages.agg(F.max("offset")).first()[0] or 0
    part = F.floor(F.col("offset") * parts / (last + 1))
    return [messages.filter(part == i) for i in range(parts)]


@query
def cdc_stream(t: Tables) -> DataFrame:
    """The same through a stream that is stopped and resumed as messages arrive, with a new base in between."""
    root = work_path(t.spark, "replica")
    messages, queue = stage(_envelopes(t), "messages"), f"{root}/queue"
    stored = _stored_accounts(t)
    replica = Replica(t.spark, f"{root}/table", CDC_TABLE, "id", stored.schema)
    replica.create(stored)
    for arrived in _in_offset_order(messages, 3):
        arrived.write.mode("append").parquet(queue)
        stream = t.spark.readStream.schema(messages.schema).parquet(queue)
        replica.run(stream, f"{root}/checkpoint").awaitTermination()
    replica.compact(0)
    return replica.current()


@query
def cdc_emit_json(t: Tables) -> DataFrame:
    """Stored rows after the events as JSON messages, written by a stream and read back."""
    root = work_path(t.spark, "emit")
    rows = cdc_apply(t)
    rows.write.parquet(f"{root}/rows")
    stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/rows")
    messages = EX.json_messages(stream, "id")
    sink = (
        messages.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    sink.awaitTermination()
    return t.spark.read.schema(messages.schema).parquet(f"{root}/out")
