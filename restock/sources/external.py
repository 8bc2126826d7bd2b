"""Databases and message queues, where their connector jars are on the class path.

Thin: they only name options.  The jobs themselves take DataFrames and run the same on files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    options = {"url": url, "pushDownPredicate": "true", "fetchsize": "10000"}
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 64,
) -> DataFrame:
    """A database table, read in parallel over ranges of a numeric column; filters are pushed to the database."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", splits)
        )
    return reader.load()


def query_jdbc(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """A query that the database runs itself."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def write_jdbc(df: DataFrame, options: Mapping[str, str], table: str, replace: bool = False, writers: int = 16) -> None:
    """Append to a database table, or empty it first and keep its definition."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("truncate", replace)
        .option("numPartitions", writers)
        .mode("overwrite" if replace else "append")
        .save()
    )


def kafka_options(
    servers: Sequence[str],
    topics: Sequence[str] = (),
    partitions: Mapping[str, Sequence[int]] | None = None,
    start: str = "earliest",
    group: str | None = None,
) -> dict[str, str]:
    """Subscribe to topics by name, or to named partitions."""
    import json

    options = {"kafka.bootstrap.servers": ",".join(servers), "startingOffsets": start, "failOnDataLoss": "true"}
    if partitions:
        options["assign"] = json.dumps({t: list(p) for t, p in partitions.items()})
    else:
        options["subscribe"] = ",".join(topics)
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Change stream with topic, partition, offset and the value as text."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def json_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as messages: the key as text and the whole row as JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_kafka(messages: DataFrame, servers: Sequence[str], topic: str, checkpoint: str):
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(servers))
        .option("kafka.compression.type", "gzip")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
