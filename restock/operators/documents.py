"""Document headers, size-complete quantities, scores, target stock and fill rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.functions import columns as C
from restock.functions.bundles import TOTAL, bundle, total_bundle, with_totals
from restock.operators.lookups import side_lookup

DOC_KEYS = ["doc", "out_org", "in_org", "skc"]
SIDES = {"out": "out_org", "in": "in_org"}
MODEL_SIDES = {"out": "model_out_org", "in": "model_in_org"}
ATTRIBUTES = (
    "run_day", "template", "batch", "source", "scene", "skc", "out_org", "in_org", "model_out_org", "model_in_org",
    "plan_id", "collection_id",
)
QUANTITIES = ("model_qty", "human_qty")


def _attributes() -> list[Column]:
    """An attribute that differs between the lines of a document takes its greatest value, the day its first."""
    return [F.min("day").alias("day"), *[F.max(c).alias(c) for c in ATTRIBUTES]]


def headers(lines: DataFrame) -> DataFrame:
    """One row per document.

    Hardly any line shares its document with others of its task, and attributes are texts, so lines are not sorted to be combined
    before they are shuffled.
    """
    return lines.repartition("doc").groupBy("doc").agg(*_attributes())


def quantities_found(lines: DataFrame) -> DataFrame:
    """Document headers with ``found``: the quantities of the sizes that a document has, by size.

    Lines are summed per size first, so a document of any length is gathered as one element per size.  Both sums are taken where
    the lines of a document lie after one shuffle.
    """
    placed = lines.repartition("doc")
    per_size = placed.groupBy("doc", "size").agg(*[F.sum(q).alias(q) for q in QUANTITIES], *_attributes())
    known = F.when(F.col("size").isNotNull(), F.struct("size", F.struct(*QUANTITIES).alias("q")))
    return per_size.groupBy("doc").agg(*_attributes(), F.map_from_entries(F.collect_list(known)).alias("found"))


def article_sizes(dim_sku: DataFrame) -> DataFrame:
    """The sizes of each article in their order, and its bundle without quantities.

    ``blank`` is the bundle of all sizes and the total with every value null, as bytes; ``places`` tells where the null of each
    size begins.  ``clash`` tells that a size has the name of the total, whose order then depends on the quantities.
    """
    listed = dim_sku.groupBy("skc").agg(F.sort_array(F.collect_set("size")).alias("listed"))
    keys = F.sort_array(F.concat("listed", F.array(F.lit(TOTAL))))
    upto = F.transform(F.sequence(F.lit(1), F.size("keys")), lambda i: F.octet_length(_null_bundle(F.slice("keys", F.lit(1), i))) - 5)
    clash = F.array_contains("listed", TOTAL)
    rows = listed.withColumn("keys", keys).withColumn("blank", F.encode(_null_bundle(F.col("keys")), "UTF-8")).withColumn("clash", clash)
    return rows.select("skc", "listed", "clash", "blank", F.when(~clash, F.map_from_arrays("keys", upto)).alias("places"))


def _null_bundle(keys: Column) -> Column:
    nothing = F.lit(None).cast("bigint")
    return F.to_json(F.transform(keys, lambda k: F.struct(k.alias("key"), nothing.alias("value"))), {"ignoreNullFields": "false"})


ARTICLE_SIZES = ("listed", "clash", "blank", "places")


def _total(entries: Column, name: str) -> Column:
    nothing = F.lit(None).cast("bigint")
    return F.aggregate(entries, nothing, lambda a, e: F.coalesce(a + e[name], a, e[name]))


def _quantity(size: Column, name: str) -> Column:
    return F.try_element_at(F.col("found"), size)[name].alias(name)


def _listed() -> Column:
    return F.coalesce("listed", F.array().cast("array<string>"))


def _sizes() -> Column:
    """The quantities of every size of the article, and their total."""
    detail = F.transform(_listed(), lambda s: F.struct(s.alias("size"), *[_quantity(s, q) for q in QUANTITIES], F.lit(0).alias("grouping_id")))
    totals = [_total(F.transform(_listed(), lambda s: F.try_element_at(F.col("found"), s)), q).alias(q) for q in QUANTITIES]
    return F.concat(detail, F.array(F.struct(F.lit(TOTAL).alias("size"), *totals, F.lit(1).alias("grouping_id"))))


def profiles(lines: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Document headers with ``sizes``: the quantities of every size of the article, and their total.

    The sizes a document lacks are filled in from the list of its article instead of multiplying the documents by them.
    """
    docs = quantities_found(lines).join(article_sizes(dim_sku).select("skc", "listed"), "skc", "left")
    return docs.withColumn("sizes", _sizes()).drop("found", "listed")


def size_quantities(lines: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Model and human quantity of each document per size of its article, and in total."""
    articles = article_sizes(dim_sku)
    names = F.transform("listed", lambda s: F.struct(s.alias("size"), F.lit(0).alias("grouping_id")))
    last = F.array(F.struct(F.lit(TOTAL).alias("size"), F.lit(1).alias("grouping_id")))
    docs = quantities_found(lines).join(articles.select("skc", "listed", F.concat(names, last).alias("names")), "skc", "left")
    of_article = F.filter(F.map_entries("found"), lambda e: F.array_contains("listed", e["key"]))
    shown = F.transform(of_article, lambda e: e["value"])
    totals = F.struct(*[_total(F.coalesce(F.col("shown"), F.array()), q).alias(q) for q in QUANTITIES])
    rows = docs.withColumn("shown", shown).select(*DOC_KEYS, "found", totals.alias("totals"), F.coalesce("names", last).alias("names"))
    rows = rows.select(*DOC_KEYS, "found", "totals", F.inline("names"))
    own = F.when(F.col("grouping_id") == 1, F.col("totals")).otherwise(F.try_element_at("found", "size"))
    rows = rows.select(*DOC_KEYS, "size", own.alias("own"), "grouping_id")
    return rows.select(*DOC_KEYS, "size", *[F.col("own")[q].alias(q) for q in QUANTITIES], "grouping_id")


def with_bundles(docs: DataFrame) -> DataFrame:
    """Each quantity of documents as a bundle, from what they ``found`` and the ``ARTICLE_SIZES`` of their articles.

    The quantities are put in their places of the article's blank bundle; the other columns stay.
    """
    kept = [c for c in docs.columns if c not in ("found", *ARTICLE_SIZES)]
    entries = F.transform(F.map_entries("found"), lambda e: F.struct(F.try_element_at("places", e["key"]).alias("place"), *[e["value"][q].alias(q) for q in QUANTITIES]))
    docs = docs.withColumn("_entries", F.filter(entries, lambda e: e["place"].isNotNull()))
    totals = F.struct(F.try_element_at("places", F.lit(TOTAL)).alias("place"), *[_total(F.col("_entries"), q).alias(q) for q in QUANTITIES])
    docs = docs.withColumn("_all", F.sort_array(F.concat("_entries", F.array(totals))))
    return docs.select(*kept, *[_bundle(q) for q in QUANTITIES])


def _bundle(name: str) -> Column:
    blank = F.col("blank")
    start = F.struct(F.lit(1).alias("at"), F.encode(F.lit(""), "UTF-8").alias("done"))

    def put(s: Column, e: Column) -> Column:
        before = F.substring(blank, s["at"], e["place"] - s["at"])
        return F.struct((e["place"] + 4).alias("at"), F.concat(s["done"], before, F.encode(e[name].cast("string"), "UTF-8")).alias("done"))

    filled = F.aggregate(
        F.filter("_all", lambda e: e[name].isNotNull()),
        start,
        put,
        lambda s: F.concat(s["done"], F.substring(blank, s["at"], F.lit(2**31 - 1))).cast("string"),
    )
    pairs = F.transform(F.sort_array(_sizes()), lambda s: F.struct(s["size"].alias("key"), s[name].alias("value")))
    plain = F.to_json(pairs, {"ignoreNullFields": "false"})
    return F.when(blank.isNull() | F.col("clash"), plain).otherwise(filled).alias(name)


def quantity_bundles(lines: DataFrame, dim_sku: DataFrame) -> DataFrame:
    docs = quantities_found(lines).join(article_sizes(dim_sku), "skc", "left")
    return with_bundles(docs).select(*DOC_KEYS, *QUANTITIES)


def min_bundles(earlier_sizes: DataFrame) -> DataFrame:
    """Stored bundles per (org, skc, batch); of several templates the lowest text is taken."""
    keys = ["org", "skc", "template", "batch"]
    metrics = ["before_qty", "after_qty"]
    per_template = total_bundle(earlier_sizes, keys, metrics)
    return per_template.groupBy("org", "skc", "batch").agg(*[F.min(m).alias(m) for m in metrics])


def latest_batch(lines: DataFrame) -> DataFrame:
    return lines.groupBy("template").agg(F.max("batch").alias("batch"))


def batch_stock(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored stock of the model's sending and receiving org in the document's batch."""
    return side_lookup(docs, stored, MODEL_SIDES, ["before_qty", "after_qty"], on=["skc", "batch"])


def priority_scores(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """Send and receive scores of both sides in the document's batch, two decimals."""
    lowest = scores.groupBy("batch", "skc", "org").agg(
        C.score(F.min("send_score")).alias("send_score"), C.score(F.min("receive_score")).alias("receive_score")
    )
    return side_lookup(docs, lowest, SIDES, ["send_score", "receive_score"], on=["skc", "batch"])


def target_stock(targets: DataFrame) -> DataFrame:
    return with_totals(targets, ["org", "skc", "batch"], ["target"])


def target_bundles(target: DataFrame) -> DataFrame:
    return bundle(target, ["org", "skc", "batch"], ["target"])


def stock_after_model(sku_org: DataFrame) -> DataFrame:
    """Positive model stock per (org, skc)."""
    positive = sku_org.filter(F.col("after_model_include_stock") > 0)
    return positive.groupBy("org", "skc").agg(F.sum("after_model_include_stock").alias("after_stock"))


def fill_rates(docs: DataFrame, target: DataFrame, after: DataFrame) -> DataFrame:
    """Stock after the model over target stock, both sides; 0 where the target is 0, NULL where there is none."""
    totals = target.filter(F.col("grouping_id") == 1).select("org", "skc", "batch", "target")
    rows = side_lookup(docs, totals, SIDES, ["target"], on=["skc", "batch"])
    rows = side_lookup(rows, after, SIDES, ["after_stock"], on=["skc"])
    return rows.select(
        *docs.columns,
        "out_target",
        "in_target",
        C.ratio("out_after_stock", "out_target").alias("out_fill"),
        C.ratio("in_after_stock", "in_target").alias("in_fill"),
    )
