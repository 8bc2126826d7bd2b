"""A training corpus from raw documents: keep good texts, one of each copy and near copy, mix the sources, encode.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, with the columns of documents; the last gives the
token ids.  Between stages the documents are written and read again, and a stage that begins discards what the one before
it, of the same folder and thread, had written on its way: its result must have been written by then.

Common to all stages: texts are taken whole, however long; a null text counts as an empty one but stays null; rows of null or
repeated ids are rows like others; columns besides doc_id, text and source are carried whatever their names; no rows give none.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.llm import exact, labelled, mixing, near, piece, quality
from restock.session import collected, configure, discard, stage

MODEL = "piece_bpe_32k.model"
_before: dict[tuple, list[str]] = {}  # what the stage before has written on its way, by run

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage_of_pipeline(function: Stage) -> Stage:
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = (spark.sparkContext.applicationId, threading.get_ident(), sf_dir)
        discard(configure(spark), _before.pop(own, []))
        with collected() as paths:
            out = function(spark, docs, sf_dir)
        _before[own] = paths
        return out

    return run_stage


@stage_of_pipeline
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by trees fitted to the labels; labels only train, and a third of them is held out.

    Empty texts are scored like others; repeated rows have one score and stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = quality.train(labelled.sample(docs, labels, "quality", labelled.in_fold("doc_id", 3, 1)))
    return docs.filter(quality.score(F.col("text"), forest) >= 0.5)


@stage_of_pipeline
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the one with the smallest id.

    Null and empty texts are equal.  Ids that are null come after all others; of rows with one id, one stays.
    """
    return exact.deduplicate(docs)


@stage_of_pipeline
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their five-word shingles, the one with the smallest id.

    A text of fewer words is one shingle; one without words is linked with nothing and stays.  Ids that are null come after all
    others; of rows with one id, one stays.
    """
    return near.deduplicate(docs, width=5)


@stage_of_pipeline
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, once per pass over its source.

    Null is a source like others, and comes last; a document without words is never taken.
    """
    return mixing.mix_rows(docs)


@stage_of_pipeline
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit, begin and end included), and digests of the ids and of their text.

    A null or empty text has the begin and the end id alone.
    """
    model = public_tokenizers.path(MODEL)
    coded = docs.select("doc_id", piece.there_and_back(F.col("text"), model).alias("c"))
    return coded.select("doc_id", "c.*").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

# The classifier, the minhash candidates and the draws have no SQL; the tests run each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{at}")
    return docs
