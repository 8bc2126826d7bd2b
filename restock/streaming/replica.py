"""A replica table kept up to date by a change stream.

Each micro-batch appends its parsed events to a log, in a folder named by the batch, so its cost follows the
number of events and not the size of the table.  A batch that is run again replaces its own folder.  The offsets that
batches have taken are noted; messages at offsets that another batch has taken are left out, so that a stream that is started anew
from its beginning logs nothing twice.  Reading folds the log into the last base; ``compact`` writes that as the next base.  A base counts only once its name is
in the pointer, which is written last.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from restock.operators import changes as CH
from restock.session import stage

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])),
        T.StructField("key", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("changed", T.MapType(T.StringType(), T.StringType())),
        T.StructField("batch", T.LongType()),
    ]
)

TAKEN_SCHEMA = "partition int, block bigint, low bigint, high bigint, batch bigint"
BLOCK = 4096  # offsets

REJECT_SCHEMA = "partition int, offset bigint, reason string, text string, batch bigint"


@dataclass
class Replica:
    """Replica of one source table in the folder ``root``."""

    spark: SparkSession
    root: str
    table: str
    key: str
    schema: T.StructType

    @property
    def _log(self) -> str:
        return f"{self.root}/log"

    @property
    def _rejects(self) -> str:
        return f"{self.root}/rejects"

    def create(self, stored: DataFrame) -> None:
        """Start from a first copy of the table."""
        self._write_base(stored.select(*self.schema.names), -1)

    def append(self, envelopes: DataFrame, batch: int) -> None:
        """Add one micro-batch of change envelopes to the log; what cannot be applied goes to the rejects.

        The offsets are noted last: a batch that broke off before is run again under its number and replaces what it wrote.
        """
        events = stage(CH.checked(self._untaken(envelopes, batch), self.table, self.schema, self.key), "messages")
        CH.rejected(events).write.mode("overwrite").parquet(f"{self._rejects}/batch={batch}")
        CH.accepted(events).select("seq", "key", "op", "data", "changed").write.mode("overwrite").parquet(
            f"{self._log}/batch={batch}"
        )
        self._note(envelopes, batch)

    def _note(self, envelopes: DataFrame, batch: int) -> None:
        """Note the offsets of a batch as ranges, each within a block of offsets."""
        block = F.floor(F.col("offset") / BLOCK).alias("block")
        held = envelopes.groupBy("partition", block).agg(F.sort_array(F.collect_set("offset")).alias("o"))  # no more than BLOCK
        low, high = F.col("o")[0], F.element_at("o", -1)
        whole = F.array(F.struct(low.alias("low"), high.alias("high")))
        each = F.transform("o", lambda x: F.struct(x.alias("low"), x.alias("high")))
        ranges = held.select("partition", "block", F.inline(F.when(F.size("o") == high - low + 1, whole).otherwise(each)))
        ranges.write.mode("overwrite").parquet(f"{self.root}/taken/batch={batch}")

    def _untaken(self, envelopes: DataFrame, batch: int) -> DataFrame:
        """The envelopes at offsets that no other batch has taken."""
        try:
            taken = self.spark.read.schema(TAKEN_SCHEMA).parquet(f"{self.root}/taken").filter(F.col("batch") != batch)
        except AnalysisException:  # no batch yet
            return envelopes
        ranges = taken.select(F.col("partition").alias("_partition"), F.col("block").alias("_block"), "low", "high")
        same = (F.col("partition") == F.col("_partition")) & (F.floor(F.col("offset") / BLOCK) == F.col("_block"))
        return envelopes.join(ranges, same & F.col("offset").between(F.col("low"), F.col("high")), "left_anti")

    def run(self, envelopes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Consume a stream of (partition, offset, value) rows until it has no more; progress is kept in ``checkpoint``.

        A new checkpoint counts its batches from 0; they are numbered on after those already logged.
        """
        first = self._first(checkpoint)
        return (
            envelopes.writeStream.foreachBatch(lambda rows, batch: self.append(rows, first + batch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def rejects(self) -> DataFrame:
        """Messages that could not be applied: position, reason, text and batch."""
        return self.spark.read.schema(REJECT_SCHEMA).parquet(self._rejects)

    def _first(self, checkpoint: str) -> int:
        """The number of a checkpoint's first batch, noted when it is first seen."""
        path = f"{self.root}/checkpoints"
        try:
            known = self.spark.read.parquet(path).filter(F.col("checkpoint") == checkpoint).agg(F.min("first")).first()[0]
        except AnalysisException:
            known = None
        if known is not None:
            return known
        try:
            logged = self.spark.read.schema(EVENT_SCHEMA).parquet(self._log).agg(F.max("batch")).first()[0]
        except AnalysisException:
            logged = None
        first = max(self._pointer()[1], -1 if logged is None else logged) + 1
        note = self.spark.range(1).select(F.lit(checkpoint).alias("checkpoint"), F.lit(first).cast("bigint").alias("first"))
        note.coalesce(1).write.mode("append").parquet(path)
        return first

    def current(self, upto: int | None = None) -> DataFrame:
        """The table as of the last logged batch, or of an earlier one that is not yet part of the base."""
        version, done = self._pointer()
        base = self.spark.read.schema(self.schema).parquet(f"{self.root}/base/{version}")
        try:
            log = self.spark.read.schema(EVENT_SCHEMA).parquet(self._log)
        except AnalysisException:  # nothing logged yet
            return base
        new = F.col("batch") > done
        return CH.apply(base, log.filter(new if upto is None else new & (F.col("batch") <= upto)), self.key)

    def compact(self, upto: int) -> None:
        """Fold the log up to a batch into a new base."""
        self._write_base(self.current(upto), upto)

    def _write_base(self, rows: DataFrame, upto: int) -> None:
        # Base names are fresh, so an interrupted write is never read.
        version = f"upto={upto}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/base/{version}")
        pointer = self.spark.range(1).select(F.lit(version).alias("version"), F.lit(upto).cast("bigint").alias("upto"))
        pointer.coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")

    def _pointer(self) -> tuple[str, int]:
        last = self.spark.read.parquet(f"{self.root}/pointer").orderBy(F.desc("upto")).first()
        return last.version, last.upto
