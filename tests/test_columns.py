from decimal import Decimal

from pyspark.sql import functions as F

from restock.functions import bundles as BU
from restock.functions import columns as C


def values(spark, schema, rows, **columns):
    df = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()])
    return [tuple(r) for r in df.collect()]


def test_class_level(spark):
    rows = [("a",), ("a:b",), ("a:b:c",), ("a:b:c:d",), ("a:b:c:d:e",), (None,)]
    df = spark.createDataFrame(rows, "codes string").withColumn("types", F.lit("A:B:C:D:E"))
    depth, code, label = C.class_level("codes", "types")
    assert [tuple(r) for r in df.select(depth, code, label).collect()] == [
        (1, None, None),
        (2, "a", "A#a"),
        (3, "b", "A#a&B#b"),
        (4, "c", "A#a&B#b&C#c"),
        (5, None, None),
        (None, None, None),
    ]


def test_class_level_with_short_type_path(spark):
    depth, code, label = C.class_level("codes", "types")
    assert values(spark, "codes string, types string", [("a:b:c:d", "A"), ("a:b", None)], c=code, l=label) == [
        ("c", "A#a&#b&#c"),
        (None, None),
    ]


def test_at_level(spark):
    rows = [
        ("U:R:S", "1:2:3", "R"),
        ("U:R:S", "1:2:3", "X"),
        ("U:R", "1:2:3", "R"),
        ("U:R:R", "1:2:3", "R"),
        (None, "1", "U"),
        ("U", "1", None),
    ]
    got = values(spark, "names string, vals string, level string", rows, v=C.at_level("names", "vals", "level"))
    assert got == [("2",), (None,), (None,), ("3",), (None,), (None,)]


def test_first_non_blank(spark):
    rows = [("p", "c"), ("", "c"), ("None", "c"), (None, ""), ("None", "None")]
    value, label = C.first_non_blank({"plan_id": "a", "collection_id": "b"})
    assert values(spark, "a string, b string", rows, v=value, l=label) == [
        ("p", "plan_id"),
        ("c", "collection_id"),
        ("c", "collection_id"),
        (None, None),
        (None, None),
    ]


def test_ratio_and_score(spark):
    rows = [(1, 200), (1, 3), (2, 3), (5, 0), (None, 4), (5, None)]
    got = values(spark, "n bigint, d bigint", rows, r=C.ratio("n", "d"))
    assert got == [(Decimal(x),) if x is not None else (None,) for x in ("0.01", "0.33", "0.67", "0.00", "0.00", None)]
    scored = spark.sql("select cast('1.005' as decimal(10,3)) as s").select(C.score("s").alias("s"))
    assert scored.first().s == Decimal("1.01")
    assert scored.schema["s"].dataType.simpleString() == "decimal(16,2)"


def test_level_labels_and_sentinel(spark):
    rows = [("1",), ("2",), ("3",), ("9",), (None,)]
    assert values(spark, "c string", rows, l=C.sales_level_label("c"), o=C.org_or_sentinel("c")) == [
        ("畅", "1"), ("平", "2"), ("滞", "3"), (None, "9"), (None, "111"),
    ]


def test_json_setting_with_a_dot_in_its_name(spark):
    rows = [('{"gto.replenish_transfer_level":"region"}',), ('{"x":1}',), (None,)]
    got = values(spark, "j string", rows, v=C.json_setting("j", C.TRANSFER_LEVEL_PARAMETER))
    assert got == [("region",), (None,), (None,)]


def test_totals_tell_a_missing_size_from_the_total(spark):
    df = spark.createDataFrame([("a", "S", 1), ("a", None, 2)], "k string, size string, v bigint")
    got = {tuple(r) for r in BU.with_totals(df, ["k"], ["v"]).collect()}
    assert got == {("a", "S", 1, 0), ("a", None, 2, 0), ("a", "total", 3, 1)}


def test_bundles_keep_nulls_and_sort_by_key(spark):
    df = spark.createDataFrame([("a", "M", None), ("a", "L", 2), ("a", "total", 2)], "k string, size string, v bigint")
    assert BU.bundle(df, ["k"], ["v"]).first().v == (
        '[{"key":"L","value":2},{"key":"M","value":null},{"key":"total","value":2}]'
    )
