"""Stored tables whose readers only ever see whole versions.

Rows are written into a folder with a fresh name, then the list of folders and partitions that make up the table (its
manifest), and last a line in the pointer that names the manifest.  A write that fails leaves the old state readable, and
rows may be computed from the very table they replace.  Of two writers at a time, neither loses what the other wrote: a
commit is based on the last one there is, and raises ``Conflict`` if that changed what its rows were computed from.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.sources.commits import CommitLog, Conflict, folders, remove

VERSION = "_version"


class Store:
    """The table in the folder ``root``, by partitions of one column or whole.  NULL is a partition like others."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition: str | None = None):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, partition
        self.commits = CommitLog(spark, self.root)

    # With ``since``, the number of the commit that rows were computed from, a write is a conflict if what it replaces has
    # changed after that commit.  Without it, rows come from elsewhere, and the later write counts.

    def head(self) -> int:
        """The number of the last commit."""
        return self.commits.head()

    def replace(self, rows: DataFrame, since: int | None = None) -> Store:
        """All rows anew."""
        self._commit(self._write(rows), None, since)
        return self

    def replace_partitions(self, rows: DataFrame, touched: DataFrame, since: int | None = None) -> Store:
        """The partitions listed in ``touched`` hold ``rows`` from now on, or nothing; all others stay as they are."""
        self._commit(self._write(rows), touched.select(self.partition).distinct(), since)
        return self

    def append(self, rows: DataFrame) -> Store:
        """Rows added to what there is; their columns are matched by name."""
        self._commit(self._write(rows), self.spark.createDataFrame([], self._manifest_schema).drop(VERSION), None)
        return self

    def current(self) -> DataFrame:
        """The table as of the last commit; without one it is empty."""
        number = self.head()
        if not number:
            return self.spark.createDataFrame([], self.schema)
        state = self.commits.read(number)
        rows = self._data(state["versions"])
        if self.partition:
            live = self._manifest(state).select(F.col(VERSION).alias("live"), F.col(self.partition).alias("part"))
            rows = rows.join(live, (F.col(VERSION) == F.col("live")) & F.col(self.partition).eqNullSafe(F.col("part")), "left_semi")
        return rows.select(*self.schema.names)

    def compact(self) -> Store:
        """The same rows in one version."""
        number = self.head()
        return self.replace(self.current(), number)

    def vacuum(self, keep: int = 1) -> None:
        """Delete what none of the last ``keep`` commits reads; nobody may be reading or writing anything older."""
        states = self.commits.forget(keep)
        live = {v for s in states for v in s["versions"]}
        dead = [f"data/{n}" for n in folders(self.spark, f"{self.root}/data") if n.startswith(f"{VERSION}=") and n.removeprefix(f"{VERSION}=") not in live]
        kept = {s[part] for s in states for part in ("manifest", "touched")}
        dead += [f"manifest/{n}" for n in folders(self.spark, f"{self.root}/manifest") if n not in kept]
        remove(self.spark, [f"{self.root}/{n}" for n in dead])

    @property
    def _manifest_schema(self) -> T.StructType:
        part = [self.schema[self.partition]] if self.partition else []
        return T.StructType([T.StructField(VERSION, T.StringType()), *part])

    def _manifest(self, state: dict) -> DataFrame:
        return self._listed(state["manifest"])

    def _listed(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._manifest_schema).parquet(f"{self.root}/manifest/{name}")

    def _data(self, versions: list[str]) -> DataFrame:
        """Rows of versions that are in use; folders of others are not looked into."""
        paths = [f"{self.root}/data/{VERSION}={v}" for v in versions]
        schema = T.StructType([*self.schema.fields, T.StructField(VERSION, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def _write(self, rows: DataFrame) -> str:
        version, rows = uuid.uuid4().hex, rows.select(*self.schema.names)
        if self.partition:  # rebalanced: few files per partition, and a large one is written by many tasks
            writer = rows.hint("rebalance", F.col(self.partition)).write.partitionBy(self.partition)
        else:
            writer = rows.write
        writer.parquet(f"{self.root}/data/{VERSION}={version}")
        return version

    def _write_list(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.coalesce(1).write.parquet(f"{self.root}/manifest/{name}")
        return name

    def _same_partitions(self, a: DataFrame, b: DataFrame) -> bool:
        one, other = a.select(self.partition), b.select(F.col(self.partition).alias("other"))
        return not one.join(other, F.col(self.partition).eqNullSafe(F.col("other")), "left_semi").isEmpty()

    def _commit(self, version: str, touched: DataFrame | None, since: int | None) -> None:
        """Make a written version part of the table, in place of everything (None) or of the touched partitions.

        A commit names the versions in use, the list of their partitions, and the list of partitions it has touched.
        """
        own = self.spark.range(1).select(F.lit(version).alias(VERSION))
        if self.partition:
            written = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{VERSION}={version}")
            own = written.select(F.lit(version).alias(VERSION), self.partition).distinct()
        changes, everything = own, touched is None
        if self.partition and not everything:
            changes = own.unionByName(touched.select(F.lit(None).cast("string").alias(VERSION), self.partition))
        changed = self._write_list(changes)

        def make(head: int, state: dict | None) -> dict:
            listed = own
            if state and not everything:
                old = self._manifest(state)
                if self.partition:
                    gone = touched.select(F.col(self.partition).alias("gone"))
                    old = old.join(gone, F.col(self.partition).eqNullSafe(F.col("gone")), "left_anti")
                listed = old.unionByName(own)
            name = self._write_list(listed)
            versions = [r[0] for r in self._listed(name).select(VERSION).distinct().collect()]
            return {"manifest": name, "versions": versions or [version], "touched": changed, "everything": everything}

        def check(other: dict) -> None:
            if everything or other["everything"] or not self.partition or self._same_partitions(self._listed(changed), self._listed(other["touched"])):
                raise Conflict(f"{self.root} has changed after commit {since}")

        self.commits.commit(make, since, check)
