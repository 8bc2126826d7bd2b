"""Whole rows written for later steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from restock.session import work_path


def store(df: DataFrame, name: str) -> DataFrame:
    """As ``stage``, but packed more tightly: for tables that hold texts."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
