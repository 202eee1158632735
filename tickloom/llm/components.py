"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.workspace import settle


def _with_least(edges: DataFrame, name: str) -> DataFrame:
    """Directed edges ``u, v`` with the least neighbour ``m`` of ``u``, or ``u`` itself.

    The minimum is worked out within tasks first and written, so that the join with the
    edges of a node with very many is one Spark can split.
    """
    least = settle(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    return edges.join(least, "u")


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node connected with it, of all nodes with edges.

    Each step hangs all larger neighbours of a node, then all smaller ones, on the least
    of them; it ends when every node hangs on its root.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs = settle(pairs, "edges")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "least").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.distinct(), "edges")
        small = _with_least(large, "least")
        # The node itself hangs on the least, and so do its other smaller neighbours.
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        own = small.select("u", F.col("m").alias("v")).filter("u <> v")
        pairs = settle(hung.unionByName(own).distinct(), "edges")
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
