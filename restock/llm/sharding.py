"""Uniform shuffle into shards of exact size, by a communication matrix drawn ahead of the exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.draws import split
from restock.session import stage

BUCKET_ROWS = 100_000


def shard(rows: DataFrame, shards: int, seed: int = 1, fan: int = 16) -> DataFrame:
    """All rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one row at most.  How many rows each input partition sends to each shard is drawn from the
    multivariate hypergeometric law; each partition is permuted and cut by these counts, and each shard is permuted
    again.  Every arrangement is thus as likely as any other, and no row needs to know of another partition's rows.

    The input is written once, so that partitions and positions hold whatever executor is lost; only positions are
    ranked, and the columns move once, at the end.  Shards are ranked in buckets of a random key.  Values of the rows
    play no part: nulls, ties, repeated rows and hot keys are rows like others.  An empty table gives no rows.
    Columns of the input named ``shard`` or ``slot`` are replaced.
    """
    kept = stage(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "shard-rows")
    spots = kept.select("at", F.shiftright("at", 33).alias("leaf"))
    parts = stage(spots.groupBy("leaf").agg(F.count("*").alias("size")), "shard-parts")
    found = parts.agg(F.max("leaf"), F.sum("size")).first()
    leaves, total = (found[0] or 0) + 1, found[1] or 0
    sizes = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.lit(total // shards) + F.when(j < total % shards, 1).otherwise(0)
    )
    pools = rows.sparkSession.range(1).select(F.transform(sizes, lambda x: x.cast("bigint")).alias("pools"))
    matrix = split(parts, pools, leaves, seed, fan)
    upto = F.aggregate(
        "quota",
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.expr("cast(array() as array<bigint>)").alias("out")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"] + x)).alias("out")),
        lambda a: a["out"],
    )
    matrix = stage(matrix.select("leaf", upto.alias("upto")), "shard-matrix")

    local = Window.partitionBy("leaf").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), "at"), "at")
    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    sent = (
        spots.withColumn("rank", F.row_number().over(local))
        .join(matrix, "leaf")
        .select(
            "at",
            F.size(F.filter("upto", lambda x: x < F.col("rank"))).alias("shard"),
            F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), "at"), F.lit(buckets)).alias("bucket"),
        )
    )
    sent = stage(sent, "shard-sent")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    again = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64(F.lit(seed), F.lit("again"), "at"), "at")
    placed = (
        sent.withColumn("rank", F.row_number().over(again))
        .join(starts, ["shard", "bucket"])
        .select("at", "shard", (F.col("start") + F.col("rank") - 1).alias("slot"))
    )
    carried = [F.col(f"row.`{c}`").alias(c) for c in rows.columns if c.lower() not in ("shard", "slot")]
    return kept.join(placed, "at").select(*carried, "shard", "slot")
