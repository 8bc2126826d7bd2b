"""Wide facts are attached to documents in few joins."""

from pyspark.sql import functions as F

from restock.operators.lookups import PART, beside, packed_lookup, side_lookup, unpack
from restock.plans.detail import RUN_KEY, SHOWN_BY, _keyed
from restock.queries import CATALOGUE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_take_what_they_show_in_five_joins(spark):
    assert plan(CATALOGUE["doc_detail"](spark, "/root/testdata/sf0.001")).count("ShuffledHashJoin") == 5


def test_facts_of_one_type_are_found_as_when_looked_up_one_by_one(spark):
    docs = spark.createDataFrame([("1", "a", "x", "y"), ("2", "a", "y", None), ("3", None, "x", "x"), ("4", "b", "z", "y")], "doc string, skc string, o string, i string")
    rows = [("x", "a", "s", None, 1, 2, None), ("y", "a", None, "t", None, 4, "1.25"), ("y", "b", "u", "v", 5, None, "2.50")]
    facts = spark.createDataFrame(rows, "org string, skc string, s string, t string, m bigint, n bigint, d string").withColumn("d", F.col("d").cast("decimal(16,2)"))
    values, sides = ["s", "m", "t", "d", "n"], {"out": "o", "in": "i"}
    dealt, alike = beside(docs, ["skc"], "doc", parts=3)
    found = unpack(packed_lookup(dealt, facts, sides, values, ["skc"], alike=alike), {f"{s}_facts": s for s in sides}).drop(PART)
    plain = side_lookup(docs, facts, sides, values, ["skc"]).select(*found.columns)
    assert found.dtypes == plain.dtypes and sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)


def test_missing_parts_of_a_run_equal_each_other(spark):
    rows = spark.createDataFrame([("1", "t", None, "s", None), ("2", None, None, None, None)], "v string, template string, batch int, scene string, source string")
    met = _keyed(rows).join(_keyed(rows).select(RUN_KEY, F.col("v").alias("w")), RUN_KEY)
    assert sorted((r.v, r.w) for r in met.collect()) == [("1", "1"), ("2", "2")] and met.select(*SHOWN_BY).columns == list(SHOWN_BY)
