from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from restock.plans.publish import publish
from restock.session import shared_folder, work_path
from restock.sources import external as EX
from restock.sources import replicate as RP
from restock.sources import tables as TB
from restock.sources.keyed import KeyedStore
from restock.sources.store import Store


def test_batches_replace_only_their_partitions(spark, tmp_path):
    old = spark.createDataFrame([(1, "old"), (2, "old"), (2, "gone")], "batch_id int, v string")
    target = Store(spark, str(tmp_path / "t"), old.schema, "batch_id").replace(old)
    source = spark.createDataFrame([(1, "new"), (2, "new")], "batch_id int, v string")
    RP.sync_batches(source, target, RP.parse_batches("2"))
    assert sorted((r.batch_id, r.v) for r in target.current().collect()) == [(1, "old"), (2, "new")]
    assert sorted((r.batch_id, r.v) for r in target.compact().current().collect()) == [(1, "old"), (2, "new")]


def test_a_failed_write_leaves_the_old_state(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    for partition in (None, "k"):
        target = Store(spark, str(tmp_path / f"by-{partition}"), old.schema, partition)
        assert target.current().collect() == []
        target.replace(old)
        broken = old.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
        for write in (lambda: target.replace(broken), lambda: target.append(broken)):
            with pytest.raises(Exception, match="broken"):
                write()
        assert sorted(r.v for r in target.current().collect()) == ["a", "b"]
        target.append(old.select("v", "k"))
        assert sorted(r.v for r in target.current().collect()) == ["a", "a", "b", "b"]


def test_a_table_as_a_query_is_replaced_whole(spark, tmp_path):
    TB.create_table_as(spark.range(3), "restock_ctas", str(tmp_path / "one"))
    with pytest.raises(Exception, match="broken"):
        TB.create_table_as(spark.range(3).select(F.raise_error(F.lit("broken")).cast("string").alias("id")), "restock_ctas", str(tmp_path / "two"))
    assert spark.table("restock_ctas").count() == 3
    assert TB.create_table_as(spark.range(5), "restock_ctas", str(tmp_path / "three")).count() == 5
    spark.sql("DROP TABLE restock_ctas")


def test_plan_skips_by_literal_patterns(spark):
    rows = [
        ("a", "batch_id", "int"), ("a", "x", "string"), ("b", "batch_id", "string"), ("c_bak", "x", "int"),
        ("cbak", "x", "int"), ("d_1_prt_3", "x", "int"), ("e_tmp", "x", "int"), ("tmp_f", "x", "int"),
        ("denied", "x", "int"),
    ]
    columns = spark.createDataFrame(rows, "table string, column string, type string")
    got = [(r.table, r.mode) for r in RP.sync_plan(columns, ["denied"]).collect()]
    assert got == [("a", "batches"), ("b", "full"), ("cbak", "full")]


def test_sync_tables(spark, tmp_path):
    tables = {
        "a": spark.createDataFrame([(1, "x"), (2, "y")], "batch_id int, v string"),
        "b": spark.createDataFrame([("z",)], "v string"),
    }
    plan = RP.sync_plan(RP.catalog_columns(tables, spark))
    copies = RP.sync_tables(plan, tables, str(tmp_path), [2])
    assert {n: [r.v for r in c.current().collect()] for n, c in copies.items()} == {"a": ["y"], "b": ["z"]}


def test_csv_tells_null_from_empty(spark, tmp_path):
    rows = [(1, "", None), (2, None, 0.1), (3, 'a,"b"\\c', 1e-12)]
    df = spark.createDataFrame(rows, "id bigint, s string, d double")
    TB.write_csv(df, str(tmp_path / "c"))
    back = TB.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_that_does_not_fit_stops_the_load(spark, tmp_path):
    TB.write_csv(spark.createDataFrame([("x",)], "id string"), str(tmp_path / "c"))
    with pytest.raises(Exception):
        TB.read_csv(spark, str(tmp_path / "c"), spark.createDataFrame([], "id bigint").schema).collect()


def test_distributed_sink_stores_decimals(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") / 4).alias("d"))
    stored = TB.write_distributed(df, str(tmp_path / "o"), "k")
    assert stored.schema["d"].dataType.simpleString() == "decimal(38,6)"
    assert stored.agg(F.sum("d").cast("double")).first()[0] == 45 / 4


def test_day_slice_reads_one_partition(spark, tmp_path):
    df = spark.sql("select id, date_add(date '2024-01-01', cast(id % 5 as int)) as day, '0' as is_deleted from range(50)")
    df.write.partitionBy("day").parquet(str(tmp_path / "d"))
    sliced = TB.day_slice(spark.read.parquet(str(tmp_path / "d")), "2024-01-03")
    assert sliced.count() == 10
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_publish_leaves_other_partitions(spark, tmp_path):
    stored = spark.createDataFrame(
        [("a#1", "a", 1, 2023), ("a#2", "a", 1, 2023), ("b#1", "b", 1, 2024), ("b#2", "b", 1, 2024), ("c#1", "c", 1, 2024)],
        "id string, doc string, qty bigint, batch int",
    )
    results = KeyedStore(spark, str(tmp_path / "p"), stored.schema, "doc").replace(stored)
    fresh = spark.createDataFrame([("c#new", "c", 7, 2024)], stored.schema)
    got = sorted((r.id, r.qty) for r in publish(results, fresh).collect())
    assert got == [("a#1", 1), ("a#2", 1), ("b#1", 1), ("c#new", 7)]
    again = sorted((r.id, r.qty) for r in publish(results, fresh).collect())
    assert again == got
    assert sorted((r.id, r.qty) for r in publish(results, fresh.limit(0)).collect()) == got


def test_publish_finds_documents_in_other_partitions(spark, tmp_path):
    """A document that changes its partition, one that loses it, and one whose partition is NULL."""
    stored = spark.createDataFrame(
        [("a#1", "a", 1, None), ("b#1", "b", 1, None), ("c#1", "c", 1, 2024), ("d#1", "d", 1, 2024), ("e#1", "e", 1, 2025)],
        "id string, doc string, qty bigint, batch int",
    )
    results = KeyedStore(spark, str(tmp_path / "p"), stored.schema, "doc").replace(stored)
    fresh = spark.createDataFrame([("a#new", "a", 7, None), ("c#new", "c", 8, 2025), ("d#new", "d", 9, None)], stored.schema)
    got = sorted((r.id, r.batch) for r in publish(results, fresh).collect())
    assert got == [("a#new", None), ("b#1", None), ("c#new", 2025), ("d#new", None), ("e#1", 2025)]


def test_message_options():
    o = EX.kafka_options(["h1:1", "h2:2"], ["a", "b"], group="g")
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest" and o["kafka.group.id"] == "g"
    assert EX.kafka_options(["h"], partitions={"a": [0, 2]})["assign"] == '{"a": [0, 2]}'
    assert EX.jdbc_options("jdbc:x")["pushDownPredicate"] == "true"


def session_stub(named, master):
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf={"spark.checkpoint.dir": named} if named else {}, sparkContext=context)


def test_the_shared_folder_is_the_one_the_session_names():
    assert shared_folder(session_stub("hdfs://x/shared/", "yarn")) == "hdfs://x/shared"
    assert work_path(session_stub("hdfs://x/shared/", "yarn"), "a").startswith("hdfs://x/shared/restock/a-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(session_stub(None, "yarn"))
    assert shared_folder(session_stub(None, "local[2]"))
