"""Properties that hold whatever the data, and pairs of forms that must agree."""

import compare
from pyspark.sql import functions as F

from restock.bridge import STOCK_BASES
from restock.functions import bundles as BU
from restock.operators import documents as D
from restock.operators import keysets as K
from restock.operators import runs as R
from restock.operators import tags as T
from restock.operators import upserts as U
from restock.plans import kpi
from restock.session import stage


def same(a, b):
    assert compare.spark_rows(a) == compare.spark_rows(b)


def test_total_is_the_sum_of_sizes(tables):
    rows = BU.with_totals(tables.sales, ["skc"], ["qt"])
    sizes = rows.filter("grouping_id = 0").groupBy("skc").agg(F.sum("qt").alias("qt"))
    same(rows.filter("grouping_id = 1").select("skc", "qt"), sizes)


def test_moves_cancel_out(tables):
    signed = R.signed_moves(tables.moves)
    assert signed.agg(F.sum("qty")).first()[0] == 0


def test_before_is_the_after_of_the_run_before(tables):
    signed = stage(R.signed_moves(tables.moves), "signed")
    runs = R.run_order(tables.moves)
    rows = stage(R.before_after(signed, runs, tables.dim_sku, tables.sku_org, STOCK_BASES[:1]), "rows")
    prior = rows.select("org", "sku", (F.col("row_num") + 1).alias("row_num"), F.col("after_run_before_stock").alias("prior"))
    joined = rows.join(prior, ["org", "sku", "row_num"])
    assert joined.filter("not before_run_before_stock <=> prior").isEmpty()
    # The last run leaves what all moves together leave.
    last = rows.filter(F.col("row_num") == runs.count()).groupBy("org", "skc").agg(
        F.sum("after_run_before_stock").alias("after")
    )
    net = R.net_after(signed, tables.dim_sku, tables.sku_org, STOCK_BASES[:1])
    same(last, net.filter("grouping_id = 1").select("org", "skc", F.col("after_before_stock").alias("after")))


def test_affected_documents_equal_the_form_by_role(tables):
    lines = stage(tables.moves, "moves")
    pairs = stage(K.changed_pairs(tables.recent_moves), "pairs")
    columns = ["doc", "sku", "out_org", "in_org", "model_in_org", "model_qty"]
    hit = lines
    for role in K.ORG_ROLES:
        known = pairs.select(F.col("org").alias(role), "skc", F.lit(True).alias(f"hit_{role}"))
        hit = hit.join(known, [role, "skc"], "left")
    by_role = hit.filter(F.coalesce(*[F.col(f"hit_{r}") for r in K.ORG_ROLES])).select(*columns)
    same(K.touching(lines, pairs).select(*columns), by_role)


def test_recent_lines_hold_all_changed_ones(tables):
    same(K.changed_pairs(tables.moves), K.changed_pairs(tables.recent_moves))


def test_tags_by_grain_equal_the_pivoted_union(tables):
    keys = tables.moves.select(F.col("out_org").alias("org"), "skc").distinct()
    wide = T.add_tags(keys, tables.skc_tags, tables.org_tags, tables.org_skc_tags)
    same(wide, keys.join(T.pivot_tags(kpi.tag_union(tables), ["org", "skc"]), ["org", "skc"], "left"))


def test_a_code_at_two_grains_takes_the_greatest_value(spark):
    keys = spark.createDataFrame([("o", "s"), ("o", "t")], "org string, skc string")
    skc = spark.createDataFrame([("s", "x", "5"), ("t", "x", None)], "skc string, tag_code string, tag_value string")
    org = spark.createDataFrame([("o", "x", "3")], "org string, tag_code string, tag_value string")
    pair = spark.createDataFrame([("o", "s", "y", "1")], "org string, skc string, tag_code string, tag_value string")
    union = T.pivot_tags(T.union_tags(keys, skc, org, pair), ["org", "skc"])
    same(T.add_tags(keys, skc, org, pair), union)


def test_quantities_equal_the_grouping_set_form(tables):
    lines, sku = tables.moves, tables.dim_sku
    keys = ["doc", "out_org", "in_org", "skc"]
    sums = lines.groupBy(*keys, "size").agg(F.sum("model_qty").alias("model_qty"), F.sum("human_qty").alias("human_qty"))
    sizes = lines.select(*keys).distinct().join(sku.select("skc", "size"), "skc", "left")
    long = BU.with_totals(sizes.join(sums, [*keys, "size"], "left"), keys, ["model_qty", "human_qty"])
    same(D.size_quantities(lines, sku), long)


def test_missing_orgs_are_dropped_from_moves(spark):
    lines = spark.createDataFrame(
        [("2024-01-01", None, "b", "s", "s|1", "t", 1, 5), ("2024-01-01", "a", "b", "s", "s|1", "t", 1, None)],
        "run_day string, out_org string, in_org string, skc string, sku string, template string, batch int, human_qty bigint",
    )
    got = {(r.org, r.qty) for r in R.signed_moves(lines).collect()}
    assert got == {("a", 0), ("b", 5)}


def test_runs_without_a_batch_have_no_order(spark):
    lines = spark.createDataFrame(
        [("2024-01-01", "t1", 2), ("2024-01-01", "t2", 2), ("2024-01-01", "t3", 1), ("2024-01-01", "t4", None)],
        "run_day string, template string, batch int",
    )
    got = {(r.template, r.row_num) for r in R.run_order(lines).collect()}
    assert got == {("t3", 1), ("t1", 2), ("t2", 3)}


def test_copies(spark):
    rows = spark.createDataFrame([(i, "hot") for i in range(50)] + [(100, "x")], "id int, doc string")
    assert {tuple(r) for r in U.keep_lowest_id(rows, "doc").collect()} == {(0, "hot"), (100, "x")}
    shared = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "b", 7), (None, "c", 8)], "id int, doc string, v int")
    assert {tuple(r) for r in U.keep_lowest_id(shared, "doc").collect()} == {(1, "a", 5), (1, "b", 6), (None, "c", 8)}
    assert [tuple(r) for r in U.duplicates(rows, "doc").collect()] == [("hot", 50)]


def test_lists_are_as_many_as_asked_for(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("v"))
    assert U.joined_lists(df, "g", "v").count() == 1
    lists = U.joined_lists(df, "g", "v", lists=10)
    assert lists.count() == 10
    same(U.split_lists(lists, "g", "v"), df)


def test_a_document_without_sizes_keeps_its_header(spark):
    names = ["doc", "day", *D.ATTRIBUTES, "size", *D.QUANTITIES]
    base = ["2024-01-01", *["x"] * len(D.ATTRIBUTES)]
    lines = spark.createDataFrame(
        [("a", *base, "s", 1, 2), ("b", *base, None, 3, 4)], ", ".join(f"{n} {'bigint' if n in D.QUANTITIES else 'string'}" for n in names)
    )
    sku = spark.createDataFrame([("x", "s")], "skc string, size string")
    found = {r.doc: [(s.size, s.model_qty) for s in r.sizes] for r in D.profiles(lines, sku).collect()}
    assert found == {"a": [("s", 1), ("total", 1)], "b": [("s", None), ("total", None)]}


def test_null_measures_make_no_rows(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, None)], "k string, x int, y int")
    assert [tuple(r) for r in T.melt(df, ["k"], "name", "v").collect()] == [("a", "x", 1)]
