"""Reading and writing tables as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.session import work_path


def day_slice(table: DataFrame, day: str, day_column: str = "day", deleted_column: str = "is_deleted") -> DataFrame:
    """Rows of one day that are not soft-deleted; on a table partitioned by day only that partition is read."""
    return table.filter((F.col(day_column) == F.lit(day).cast("date")) & (F.col(deleted_column) == "0"))


def parquet_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A named view on a Parquet file or folder."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write and read back, with the schema known beforehand."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# NULL is written as \N and the empty text as two quotes.
CSV = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """CSV with a header, compressed by default."""
    df.write.mode(mode).options(**CSV).option("compression", compression).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; a value that does not fit stops the load."""
    return spark.read.schema(schema).options(**CSV).option("mode", "FAILFAST").csv(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A catalog table from a query, replaced if it exists.  Its files go to a new folder: ``path`` or one in the shared folder.

    The files are written first; if that fails, a table of that name is still what it was.
    """
    spark = df.sparkSession
    location = path or work_path(spark, name)
    df.write.parquet(location)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    return spark.catalog.createTable(name, location, "parquet", df.schema)


def append_files(source: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append to a folder with an explicit column list."""
    source.select(*columns).write.mode("append").parquet(path)


def doubles_to_decimal(schema: T.StructType, decimal: str = "decimal(38,6)") -> list:
    """Select list that stores floating point columns as fixed-point numbers and keeps all others."""
    return [
        F.col(f"`{f.name}`").cast(decimal).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in schema.fields
    ]


def write_distributed(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> DataFrame:
    """Compressed columnar files with the rows of a key together.

    The rows are rebalanced by key: adaptive execution splits a key that is too large for one file and merges
    small ones.
    """
    rows = df.select(*doubles_to_decimal(df.schema)).hint("rebalance", F.col(key))
    rows.write.mode(mode).option("compression", "zlib").orc(path)
    return df.sparkSession.read.schema(rows.schema).orc(path)
