"""Labelled documents to fit a classifier on: a bounded sample, and the rows that are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000


def in_fold(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in this fold; a null id is in none."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, label: str, held_out: Column, text: str = "text", id_column: str = "doc_id", bound: int = SAMPLE) -> DataFrame:
    """(id, label, text) of at most ``bound`` labelled documents that are not held out, chosen by a hash of the id.

    A document labelled more than once has its highest label, one that is given more than once its least text.  The list
    of ids is no longer than ``bound``, so it is broadcast, and the texts are taken out of one scan.
    """
    chosen = (
        labels.filter(~held_out & F.col(label).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(bound)
    )
    texts = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
