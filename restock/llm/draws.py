"""Exact draws without replacement as column expressions, and the splitting tree built from them."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = "bigint"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; a lambda body would compute it at every step."""
    return F.transform(F.array(value), body)[0]


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(2**53))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``good`` are among ``draws`` items taken from ``total``, by inversion at ``u``.

    The probabilities are walked by their ratio over the support, at most nine deviations and ten steps to either
    side of the mean; what lies beyond is less than a double can tell from nought.  The steps grow with the root
    of the number of items.  All counts are bigint, with 0 <= good, draws <= total.
    """
    pool = F.greatest(total, F.lit(1).cast(LONG)).cast("double")
    mean = draws.cast("double") * good / pool
    spread = mean * (1 - good / pool) * (pool - draws) / F.greatest(pool - 1, F.lit(1.0))
    reach = F.ceil(F.sqrt(F.greatest(spread, F.lit(0.0))) * 9) + 10

    def walk(span: Column) -> Column:
        def heavier(w, k):
            return w * (good - k).cast("double") * (draws - k) / ((k + 1).cast("double") * (total - good - draws + k + 1))

        def whole(a, k):
            return F.struct(heavier(a["w"], k).alias("w"), (a["s"] + a["w"]).alias("s"))

        mass = F.aggregate(span, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s")), whole, lambda a: a["s"])

        def upto(at: Column) -> Column:
            def step(a, k):
                return F.struct(
                    heavier(a["w"], k).alias("w"),
                    (a["s"] + a["w"]).alias("s"),
                    F.when(a["s"] <= at, k).otherwise(a["k"]).alias("k"),
                )

            zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), span[0].alias("k"))
            return F.aggregate(span, zero, step, lambda a: a["k"])

        return let(mass * u, upto)

    zero = F.lit(0).cast(LONG)
    low = F.greatest(zero, good + draws - total, F.floor(mean).cast(LONG) - reach)
    high = F.least(good, draws, F.floor(mean).cast(LONG) + reach)
    return let(F.sequence(low, high), walk)


def multivariate(pools: Column, draws: Column, *keys: Column) -> Column:
    """How many of each pool are among ``draws`` items taken from all pools together: an array as long as ``pools``."""

    def step(a, j):
        taken = hypergeometric(a["rest"], pools[j], a["left"], uniform(*keys, j))
        return let(
            taken,
            lambda x: F.struct(
                (a["left"] - x).alias("left"),
                (a["rest"] - pools[j]).alias("rest"),
                F.concat(a["out"], F.array(x)).alias("out"),
            ),
        )

    zero = F.struct(draws.alias("left"), _total(pools).alias("rest"), F.expr("cast(array() as array<bigint>)").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(pools) - 1), zero, step, lambda a: a["out"])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast(LONG), lambda a, x: a + x)


def split(leaves: DataFrame, pools: DataFrame, count: int, seed: int, fan: int = 16) -> DataFrame:
    """Deal the pools out to the leaves: (leaf, quota), where quota has one count per pool.

    ``leaves`` is (leaf, size), leaf from 0 to ``count`` - 1 (missing ones are empty); ``pools`` is one row with an
    array of counts, ``pools``, whose sum is the sum of the sizes.  Row and column sums of the result are exact and
    its law is that of a uniform permutation of all items.  A node of the tree splits its counts among up to
    ``fan`` children, so that the nodes of a level are drawn side by side.
    """
    depth = max(0, math.ceil(math.log(max(count, 1), fan) - 1e-9))
    sizes = [leaves.select(F.col("leaf").cast(LONG).alias("node"), F.col("size").cast(LONG).alias("size"))]
    families = []
    for _ in range(depth):
        child = sizes[-1]
        family = child.groupBy(F.floor(F.col("node") / fan).alias("node")).agg(
            F.sum("size").alias("size"), F.sort_array(F.collect_list(F.struct("node", "size"))).alias("children")
        )
        families.append(family.select("node", "children"))
        sizes.append(family.select("node", "size"))
    root = F.pmod(F.size("pools"), F.lit(1)).cast(LONG)  # 0, but no constant: the join below stays one on equal keys
    nodes = pools.select(root.alias("node"), F.col("pools").alias("quota"))
    if not depth:
        return nodes.select(F.col("node").alias("leaf"), "quota")
    for level in reversed(range(depth)):
        drawn = functools.partial(_children, level=level, seed=seed)
        nodes = (
            nodes.join(families[level], "node")
            .select(F.explode(drawn(F.col("quota"), F.col("children"))).alias("child"))
            .select("child.node", "child.quota")
        )
    return nodes.select(F.col("node").alias("leaf"), "quota")


def _children(quota: Column, children: Column, level: int, seed: int) -> Column:
    def step(a, child):
        mine = multivariate(a["rest"], child["size"], F.lit(seed), F.lit(level), child["node"])
        return let(
            mine,
            lambda x: F.struct(
                F.zip_with(a["rest"], x, lambda p, q: p - q).alias("rest"),
                F.concat(a["out"], F.array(F.struct(child["node"].alias("node"), x.alias("quota")))).alias("out"),
            ),
        )

    zero = F.struct(quota.alias("rest"), F.expr("cast(array() as array<struct<node: bigint, quota: array<bigint>>>)").alias("out"))
    return F.aggregate(children, zero, step, lambda a: a["out"])
