"""Steps whose disk, memory or time grew faster than the tables."""

import random
import re

from pyspark.sql import functions as F

from restock import queries as Q
from restock.bridge import Tables
from restock.operators import deltas
from restock.operators import documents as D
from restock.operators.lookups import beside, packed_lookup, unpack
from restock.plans.publish import publish
from restock.session import DEFAULTS
from restock.sources.keyed import KeyedStore


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_facts_are_never_shuffled_with_documents(spark):
    docs = spark.range(60).selectExpr("cast(id as string) doc", "if(id % 9 = 0, null, cast(id % 4 as string)) skc", "cast(id % 5 as string) a", "cast(id % 3 as string) b")
    facts = spark.range(20).selectExpr("cast(id % 4 as string) skc", "cast(id % 5 as string) org", "id v")
    dealt, alike = beside(docs, "skc", "doc", parts=6)
    found = packed_lookup(dealt, facts, {"x": "a", "y": "b"}, ["v"], ["skc"], alike=alike)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(found))
    assert len(shuffles) == 3 and all(re.match(r"skc#\d+, _part#\d+, 6", s) for s in shuffles)
    plain = packed_lookup(docs, facts, {"x": "a", "y": "b"}, ["v"], ["skc"])
    own, theirs = (unpack(df, {"x_facts": "x", "y_facts": "y"}).select("doc", "x_v", "y_v") for df in (found, plain))
    assert sorted(own.collect(), key=str) == sorted(theirs.collect(), key=str)


def test_bundles_from_blanks_equal_bundles_of_all_sizes(spark):
    skus = [("a", "S"), ("a", 'M"é'), ("a", "zz"), ("b", "total"), ("b", "x"), ("c", None)]
    sku = spark.createDataFrame([(f"{k}|{s}", k, s) for k, s in skus], "sku string, skc string, size string")
    rows = [
        ("1", "a", "S", 5, 3), ("1", "a", "zz", None, 7), ("1", "a", "S", 5, 3), ("2", "a", 'M"é', 1, None), ("3", "b", "total", 4, 4), ("3", "b", "x", -9, 4),
        ("4", "q", "S", 4, 1), ("5", "a", "nope", 4, 1), ("6", None, "S", 4, 1), ("7", "a", None, 1, 1), ("8", "c", "S", 1, 1),
    ]
    lines = spark.createDataFrame(rows, "doc string, skc string, size string, model_qty bigint, human_qty bigint")
    lines = lines.withColumns({c: F.lit(None).cast("string") for c in ("day", *D.ATTRIBUTES) if c != "skc"})

    def listed(q):
        pairs = F.transform(F.sort_array("sizes"), lambda s: F.struct(s["size"].alias("key"), s[q].alias("value")))
        return F.to_json(pairs, {"ignoreNullFields": "false"}).alias(q)

    plain = D.profiles(lines, sku).select(*D.DOC_KEYS, *[listed(q) for q in D.QUANTITIES])
    found = D.quantity_bundles(lines, sku)
    assert sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)
    blank = D.article_sizes(sku).filter("skc = 'a'").select(F.col("blank").cast("string")).first()[0]
    assert blank == '[{"key":"M\\"é","value":null},{"key":"S","value":null},{"key":"total","value":null},{"key":"zz","value":null}]'


def test_lines_of_documents_are_shuffled_once(spark):
    lines = spark.range(5).select(*[F.lit("x").alias(c) for c in ("doc", "size", "day", *D.ATTRIBUTES)], *[F.col("id").alias(q) for q in D.QUANTITIES])
    assert plan(D.quantities_found(lines)).count("Exchange") == 1
    assert plan(D.headers(lines)).count("SortAggregate") == plan(D.headers(lines).select("doc")).count("SortAggregate") + 2
    assert int(DEFAULTS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 400


def test_events_are_spread_before_messages_are_made(spark, tmp_path):
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    events = spark.createDataFrame([(i, None, i, "view", 1.0, '{"k":1}') for i in range(9)], columns)
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made = Q._envelopes(Tables(spark, str(tmp_path)))
    assert "Exchange hashpartitioning(event_id" in plan(made) and made.count() == 9


def test_groups_with_texts_are_hashed(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(9), rng.choice(["x", "y", None]), rng.choice([None, "2024-01-02", "2024-02-01"])) for _ in range(80)]
    rows = spark.createDataFrame(rows, "g string, v bigint, t string, d string").withColumn("d", F.to_date("d"))
    rows = rows.withColumn("w", F.col("v").cast("decimal(14,2)"))
    shape = deltas.Aggregates(["g"], {"v": F.col("v"), "w": F.col("w")}, {"d": F.col("d"), "low": F.col("t")}, {"t": F.col("t")})
    found = shape.full(rows)
    plain = rows.groupBy("g").agg(F.sum("v").alias("v"), F.sum("w").alias("w"), F.min("d").alias("d"), F.min("t").alias("low"), F.max("t").alias("t"), F.count("*").alias("_rows"))
    assert found.drop("_cell").schema == plain.schema.__class__([found.schema[f.name] for f in plain.schema]) and found.schema["w"] == plain.schema["w"]
    assert sorted(found.drop("_cell").collect(), key=str) == sorted(plain.collect(), key=str)
    read = plan(shape._combined(rows))
    assert "HashAggregate" in read and "SortAggregate" not in read and "ObjectHashAggregate" not in read


def test_published_rows_are_written_once(spark, tmp_path, monkeypatch):
    import restock.plans.publish as module

    staged = []
    monkeypatch.setattr(module, "stage", lambda df, name: staged.append(name) or df.localCheckpoint())
    rows = spark.createDataFrame([("1#1", "1", 5, 1996), ("1#2", "1", 5, 1996), ("2#1", "2", 7, 1996), ("3#1", "3", 1, 1997), ("3#2", "3", 1, 1997)], "id string, doc string, qty bigint, batch int")
    store = KeyedStore(spark, str(tmp_path / "t"), rows.schema, "doc").replace(rows)
    fresh = spark.createDataFrame([("2#new", "2", 9, 1996)], rows.schema)
    found = publish(store, fresh)
    assert sorted(map(tuple, found.collect())) == [("1#1", "1", 5, 1996), ("2#new", "2", 9, 1996), ("3#1", "3", 1, 1997), ("3#2", "3", 1, 1997)]
    assert "fresh" not in staged
    assert sorted(map(tuple, publish(store, fresh.limit(0)).collect())) == sorted(map(tuple, found.collect()))


def test_lines_are_joined_once(spark, monkeypatch):
    staged, stage = [], Q.stage
    monkeypatch.setattr(Q, "stage", lambda df, called: staged.append(called) or stage(df, called))
    Q.CATALOGUE["publish_incremental"](spark, "/root/testdata/sf0.001").count()
    assert staged.count("lines") == 1
