"""Exact top-k by integer inner product, block at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.session import stage

PIVOTS = 128
SEGMENT_ROWS = 4096
BLOCK_ROWS = 128
GROUP_QUERIES = 1024
PART_SEGMENTS = 512
NO_ID = 2**63 - 1
KINDS = ("<i2", "<i4", "<i8")


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x) of the double x; null if a component is null, NaN or infinite."""
    fit = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.when(fit, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _rows(vectors) -> np.ndarray:
    """Vectors as rows, short ones filled with noughts."""
    wide = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), wide), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _small(a: np.ndarray) -> tuple[bytes, str]:
    kind = next(k for k in KINDS if not a.size or (a.min() >= np.iinfo(k).min and a.max() <= np.iinfo(k).max))
    return a.astype(kind).tobytes(), kind


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with those of ``b``, over the components that both have."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(wide, 1)
    if most < 2**53:  # doubles then hold every partial sum exactly
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products exceed 64 bits")
    return a @ b.T


def _limits(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest and least of each component by block."""
    cuts = np.arange(0, len(vectors), BLOCK_ROWS)
    return np.maximum.reduceat(vectors, cuts), np.minimum.reduceat(vectors, cuts)


def _bounds(query: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What no row of a block exceeds: the sum of each component's greatest product."""
    return products(np.maximum(query, 0), high) + products(np.minimum(query, 0), low)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, of equals the smaller id first."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _search(query: np.ndarray, own: int, floor: int, ids, vectors, high, low, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment's best rows for one query: blocks by falling bound, until a bound is below the kth score."""
    bounds = _bounds(query[None], high, low)[0]
    found_ids, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in np.argsort(-bounds, kind="stable"):
        if bounds[b] < floor:
            break
        block = slice(b * BLOCK_ROWS, (b + 1) * BLOCK_ROWS)
        scores = products(query[None], vectors[block])[0]
        good = (scores >= floor) & (ids[block] != own)
        found_ids = np.concatenate([found_ids, ids[block][good]])
        found = np.concatenate([found, scores[good]])
        best = _best(found_ids, found, k)
        found_ids, found = found_ids[best], found[best]
        if len(found) == k:
            floor = max(floor, int(found[-1]))
    return found_ids, found


def index(rows: DataFrame, vector: Column, id_column: str, scale: int = 256) -> DataFrame:
    """Segments of quantised vectors, as written to the shared folder: ids, forward index and limits of the blocks.

    Rows are put in an order in which vectors near the same pivot lie together, the pivots being some ``PIVOTS`` rows; the
    order only serves the bounds.  Every row with a whole vector is in one segment of up to ``SEGMENT_ROWS`` rows.
    """
    vectors = rows.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("id"), quantised(vector, scale).alias("q")).filter("q is not null")
    first = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("q").collect()
    pivots = _rows([r.q for r in first])
    norms = (pivots.astype(float) ** 2).sum(1)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = _rows(list(batch["q"])).astype(float)
            wide = min(own.shape[1], pivots.shape[1])
            batch["pivot"] = np.argmin(norms - 2 * own[:, :wide] @ pivots[:, :wide].astype(float).T, axis=1).astype(np.int32) if len(batch) else []
            yield batch[["pivot", "id", "q"]]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 32, 0

        def segment(ids: list[int], held: list) -> pd.DataFrame:
            vectors = _rows(held)
            high, low = _limits(vectors)
            data, kind = _small(vectors)
            return pd.DataFrame({
                "segment": [base + made], "n": [len(ids)], "width": [vectors.shape[1]], "ids": [np.array(ids, "<i8").tobytes()], "vectors": [data], "kind": [kind],
                "high": [high.astype("<i8").tobytes()], "low": [low.astype("<i8").tobytes()],
                "most": [high.max(0).astype("<i8").tobytes()], "least": [low.min(0).astype("<i8").tobytes()],
            })

        ids, held = [], []
        for batch in batches:
            for i, q in zip(batch["id"], batch["q"], strict=True):
                ids.append(i)
                held.append(q)
                if len(ids) == SEGMENT_ROWS:
                    yield segment(ids, held)
                    ids, held, made = [], [], made + 1
        if ids:
            yield segment(ids, held)

    schema = "segment long, n int, width int, ids binary, vectors binary, kind string, high binary, low binary, most binary, least binary"
    placed = vectors.mapInPandas(near, "pivot int, id long, q array<long>").repartitionByRange("pivot", "id").sortWithinPartitions("pivot", "id")
    return stage(placed.mapInPandas(build, schema), "topk-segments")


def _open(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(r.vectors, r.kind).reshape(r.n, r.width).astype(np.int64)
    return np.frombuffer(r.ids, "<i8"), vectors, np.frombuffer(r.high, "<i8").reshape(-1, r.width), np.frombuffer(r.low, "<i8").reshape(-1, r.width)


def search(segments: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows for each row whose id is divisible by ``every``.

    A query is first scored in its own segment, whose kth score is a floor for it.  Then groups of queries meet the
    segments in which a query's bound reaches its floor, and there go through the blocks in the order of their bounds.
    Nothing is left out that could be among the k best; ties go to the smaller id.  Rows with the query's id are not
    its candidates; an id given several times asks with its least vector, and each of its rows is a candidate.  Rows
    without an id are candidates, last among equals.  Fewer rows than k give as many as there are; none give none.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, vectors, high, low = _open(r)
                asked = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                floors = []
                for i in asked:
                    _, found = _search(vectors[i], ids[i], -(2**63), ids, vectors, high, low, k)
                    floors.append(int(found[-1]) if len(found) == k else -(2**63))
                yield pd.DataFrame({"segment": r.segment, "query_id": ids[asked], "q": pd.Series(list(vectors[asked]), dtype=object), "floor": np.array(floors, np.int64)})

    asked = stage(segments.mapInPandas(ask, "segment long, query_id long, q array<long>, floor long"), "topk-queries")
    groups = max(1, -(-asked.count() // GROUP_QUERIES))
    rank = Window.orderBy("segment")
    ranks = segments.select("segment", (F.row_number().over(rank) - 1).alias("at"), F.count("*").over(Window.partitionBy()).alias("of"))
    group = F.floor(F.col("at") * groups / F.col("of"))
    once = asked.groupBy("query_id").agg(F.min(F.struct("q", "segment", "floor")).alias("x")).select("query_id", "x.*")
    once = once.join(ranks, "segment").select(group.alias("group"), F.struct("query_id", "q", "floor").alias("x"))
    gathered = stage(once.groupBy("group").agg(F.collect_list("x").alias("queries")), "topk-groups")

    def reached(limits: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        queries = [x for qs in asking["queries"] for x in qs]
        if not queries:
            return limits.loc[[], ["group", "segment"]]
        q, floors = _rows([x["q"] for x in queries]), np.array([x["floor"] for x in queries])
        keep = [
            bool((_bounds(q, np.frombuffer(most, "<i8")[None], np.frombuffer(least, "<i8")[None])[:, 0] >= floors).any())
            for most, least in zip(limits["most"], limits["least"], strict=True)
        ]
        return limits.loc[keep, ["group", "segment"]]

    # A group of queries looks at the limits of many segments at a time.
    parts = max(1, -(-segments.count() // PART_SEGMENTS))

    def upto(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    limits = segments.select("segment", "most", "least", F.pmod(F.xxhash64("segment"), F.lit(parts)).alias("part"), upto(groups).alias("group"))
    asking = gathered.select("group", "queries", upto(parts).alias("part"))
    pairs = limits.groupBy("group", "part").cogroup(asking.groupBy("group", "part")).applyInPandas(reached, "group long, segment long")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, vectors, high, low = _open(r)
                out = []
                for x in r.queries:
                    found_ids, found = _search(np.asarray(x["q"], np.int64), x["query_id"], x["floor"], ids, vectors, high, low, k)
                    out += [(x["query_id"], int(i), int(s)) for i, s in zip(found_ids, found, strict=True)]
                yield pd.DataFrame(out, columns=["query_id", "id", "score"]).astype(np.int64)

    met = pairs.join(segments, "segment").join(gathered, "group")
    scored = met.mapInPandas(score, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.nullif("id", F.lit(NO_ID)).alias("id"), "score")
    )
