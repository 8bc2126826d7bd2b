"""Mix sources to target weights: exact block quotas per source, split among output shards by a tree of exact draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.draws import let, split
from restock.llm.storing import store
from restock.session import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
SHARD_BLOCKS = 32_768
BUCKETS = 1024


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``source_no`` (by code point, null last) and ``target`` words.

    Sources get ``share`` times all words by weight, none more than ``most`` times its size; what is over goes to the
    others by weight.  So a target is the lesser of its cap and a common level times its weight, and the level is found
    by going through the sources in the order in which they reach their caps.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    numbered = sizes.withColumn("source_no", F.row_number().over(order) - 1)
    numbered = numbered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int")))
    numbered = numbered.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    full, rest = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(full), F.lit(0.0))) / F.sum("weight").over(rest)
    numbered = numbered.withColumn("level", level)
    reached = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source_no"), "level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(reached["level"] * F.col("weight"), F.col("cap")))
    return numbered.select("source", "source_no", "source_size", target.alias("target"))


class Mix:
    """A mix of ``rows``: what it takes as ``pieces``, per row as ``taken``, and as texts.

    A source is the stream of its documents' words, in an order fixed by a hash of id and text, cut into blocks of
    ``block_words``.  Its quota of blocks comes nearest to its target; the list of blocks is permuted once per pass
    over the source.  The quotas of all sources are split exactly among output shards of equal size by multivariate
    hypergeometric draws, a shard takes the next blocks of each source's list, and shuffles them.  Reruns agree,
    however the rows are laid out.  ``most`` passes at most are needed, so no document is taken more often.

    Null texts have no words; a null source is a source; rows without words are taken 0 times.  Repeated rows are rows
    of their own.  An empty table gives no rows.  Other columns are carried by ``texts`` and not looked at.  A hot source
    is spread over buckets of the hash, and its blocks over all shards.
    """

    def __init__(
        self, rows: DataFrame, seed: int = 1, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, text: str = "text", source: str = "source", id_column: str = "doc_id", at: str | None = None,
    ):
        self.rows, self.text, self.at, self.block_words = rows, text, at, block_words
        spot = F.col(at) if at else F.monotonically_increasing_id()
        sized = rows.select(
            spot.alias("at"), F.col(id_column).alias("id"), F.col(source).alias("source"), words(F.col(text)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_column), F.col(text)).alias("key"),
        )
        sized = stage(sized, "mix-sizes")
        aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
        blocks = F.ceil(F.col("source_size") / block_words)
        quota = F.coalesce(F.round(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)) * blocks).cast("bigint"), F.lit(0))
        self.aims = stage(aims.withColumn("blocks", blocks).withColumn("quota", quota), "mix-targets")
        total = self.aims.agg(F.sum("quota")).first()[0] or 0
        passes = most

        sized = sized.join(self.aims.select("source", "source_no"), sized["source"].eqNullSafe(self.aims["source"])).drop(self.aims["source"])
        sized = sized.withColumn("bucket", F.pmod("key", F.lit(BUCKETS)))
        filled = sized.groupBy("source_no", "bucket").agg(F.sum("size").alias("size"))
        before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = filled.select("source_no", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("source_no", "bucket").orderBy("key", "id", "at").rowsBetween(Window.unboundedPreceding, -1)
        placed = (
            sized.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["source_no", "bucket"])
            .filter("size > 0")
            .select("at", "source_no", "size", (F.col("base") + F.col("start")).alias("start"))
        )
        spans = F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))
        edge = F.col("block") * block_words
        pieces = placed.select("*", F.explode(spans).alias("block")).select(
            "at", "source_no", "block", "size",
            (F.greatest(edge, F.col("start")) - F.col("start")).alias("first_word"),
            (F.least(edge + block_words, F.col("start") + F.col("size")) - F.greatest(edge, F.col("start"))).alias("n_words"),
            (edge >= F.col("start")).alias("opens"),
        )
        self.cut = stage(pieces, "mix-cut")
        self.sized = sized

        listed = self.cut.filter("opens").select("source_no", "block", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("epoch"))
        hashed = F.xxhash64(F.lit(seed), F.lit("block"), "source_no", "block", "epoch")
        listed = listed.withColumn("key", hashed).withColumn("bucket", F.pmod("key", F.lit(BUCKETS)))
        filled = listed.groupBy("source_no", "epoch", "bucket").agg(F.count("*").alias("n"))
        before = Window.partitionBy("source_no").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = filled.select("source_no", "epoch", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("source_no", "epoch", "bucket").orderBy("key", "block")
        listed = (
            listed.withColumn("rank", F.row_number().over(inside))
            .join(starts, ["source_no", "epoch", "bucket"])
            .select("source_no", "block", "epoch", (F.col("base") + F.col("rank") - 1).alias("position"))
        )

        shards = max(1, -(-total // shard_blocks))
        spark = rows.sparkSession
        leaves = spark.range(shards).select(F.col("id").alias("leaf"), (F.lit(total // shards) + F.when(F.col("id") < total % shards, 1).otherwise(0)).alias("size"))
        pools = self.aims.agg(F.transform(F.sort_array(F.collect_list(F.struct("source_no", "quota"))), lambda x: x["quota"]).alias("pools"))
        quotas = split(leaves, pools.filter(F.size("pools") > 0), shards, seed).select(F.col("leaf").alias("shard"), F.posexplode("quota").alias("source_no", "n"))
        so_far = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        quotas = quotas.withColumn("base", F.coalesce(F.sum("n").over(so_far), F.lit(0))).filter("n > 0")
        self.quotas = stage(quotas, "mix-quotas")
        drawn = self.quotas.select("shard", "source_no", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("position"))
        # The positions are far more than the size of the quotas lets the planner expect, so no broadcast is to be tried.
        drawn = drawn.join(listed.hint("merge"), ["source_no", "position"])
        order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit("slot"), "source_no", "position"), "source_no", "position")
        self.drawn = drawn.withColumn("slot", F.row_number().over(order) - 1)

    @property
    def pieces(self) -> DataFrame:
        """(shard, slot, source_no, block, epoch, at, first_word, n_words): a block is the pieces of one slot."""
        return self.drawn.select("shard", "slot", "source_no", "block", "epoch").join(
            self.cut.select("at", "source_no", "block", "first_word", "n_words", "size"), ["source_no", "block"]
        )

    @property
    def taken(self) -> DataFrame:
        """Per row: at, id, source, size, source_size, target, taken."""
        took = self.drawn.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        took = self.cut.select("at", "source_no", "block", "n_words").join(took, ["source_no", "block"])
        took = took.groupBy("at").agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"))
        aims = self.aims.select("source_no", "source_size", "target")
        return (
            self.sized.join(took, "at", "left")
            .join(aims, "source_no")
            .select("at", "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
        )


def mix_rows(rows: DataFrame, text: str = "text", source: str = "source", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows with the text that the mix takes of them, once per pass: all of it, or its drawn words joined by spaces.

    All columns are those of ``rows``; ``n_chars``, if there, is that of the new text.  Rows of which nothing is taken go.
    """
    kept = store(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "mix-rows")
    flat = kept.select("at", F.col(f"row.`{id_column}`").alias("id"), F.col(f"row.`{source}`").alias("source"), F.col(f"row.`{text}`").alias("text"))
    mix = Mix(flat, id_column="id", at="at", **options)
    spans = mix.pieces.groupBy("at", "epoch", "size").agg(
        F.sum("n_words").alias("n"), F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("spans")
    )
    spans = spans.select("at", "n", "size", F.when(F.col("n") < F.col("size"), F.col("spans")).alias("spans"))
    own = F.col(f"row.`{text}`")

    def drawn(found: Column) -> Column:
        cut = F.transform("spans", lambda s: F.slice(found, (s["first_word"] + 1).cast("int"), s["n_words"].cast("int")))
        return F.array_join(F.flatten(cut), " ")

    new = F.when(F.col("spans").isNull(), own).otherwise(let(F.regexp_extract_all(own, F.lit(WORD), F.lit(0)), drawn))
    joined = kept.join(spans, "at").withColumn("new", new)
    columns = [
        F.col("new").alias(c) if c == text else F.length("new").cast(rows.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c)
        for c in rows.columns
    ]
    return joined.select(*columns)
