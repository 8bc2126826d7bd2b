"""The registered queries of the operators, over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.llm import aligned, exact, labelled, mixing, near, packed, piece, quality, sequences, sharding, tokencount, topk, toxicity, variants
from restock.session import configure


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = _read(spark, folder, "documents"), labelled.in_fold("doc_id", 3, 1)
    forest = quality.train(labelled.sample(documents, _read(spark, folder, "labels"), "quality", held_out))
    scored = documents.select("doc_id", held_out.alias("held_out"), quality.score(F.col("text"), forest).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.groups(_read(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    segments = topk.index(_read(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("embedding"), "vec_id")
    return topk.search(segments, 50, 5).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _read(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.shard(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(_read(spark, folder, "documents").select("doc_id", "source", "text"))
    return mix.taken.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    links = near.Links(near.written(_read(spark, folder, "documents").select("doc_id", "text")), width=2)
    found = links.components().withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = _read(spark, folder, "documents"), labelled.in_fold("doc_id", 4, 2)
    model = toxicity.train(labelled.sample(documents, _read(spark, folder, "labels"), "toxic", held_out))
    scored = documents.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = _read(spark, folder, "documents").select("doc_id", piece.there_and_back(F.col("text"), model).alias("c"))
    return coded.select("doc_id", "c.*").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    place, files = packed.write(rows, public_tokenizers.path("byte_bpe_50k.json"), 0, 50_257)
    return packed.read(place, files).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokencount.counts(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return _read(spark, folder, "documents").select("doc_id", counted.alias("c")).select("doc_id", "c.*")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(variants.words(_read(spark, folder, "documents").select("doc_id", "text")))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = aligned.align(_read(spark, folder, "documents").select("doc_id", "text"), *paths)
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    packed_rows = sequences.pack(sequences.pieces(rows, public_tokenizers.path("byte_bpe_50k.json"), 2))
    return packed_rows.withColumnRenamed("id", "doc_id")


CATALOGUE = {
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_packed_ids": op6_packed_ids,
    "op7_topk": op7_topk,
    "op8_sharding": op8_sharding,
    "op9_token_counts": op9_token_counts,
    "op10_mixing": op10_mixing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_sequence_packing": op13_sequence_packing,
}
