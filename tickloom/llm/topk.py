"""Exact top-k by inner product: ball trees searched by branch and bound.

Candidates are dealt into shards of bounded size. A task holds one shard and one block of
queries, builds a ball tree, and visits its nodes for each query by falling upper bound
(product with the centre, plus radius times the length of the query), until no node can
beat the k-th score so far. The k-th scores found in the first shards are handed to the
others, which start with them. Answers of all shards meet in one ranking per query, of
k rows from each shard.

Numbers are whole: components are scaled and rounded down, and products are exact. Where
components are so large that a product might not fit 64 bits, the query fails and says so.

Cases: vectors that are null, empty or hold null, NaN or infinite components take no part,
nor do rows without an id. Vectors of different length have no product. Equal scores go by
smaller id. Repeated rows are candidates each; a query that occurs several times is asked
once (with the smallest of its vectors), and no row with its id is an answer. A query with
fewer than k candidates has fewer answers; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.workspace import settle

SCALE = 256
TOP = 5
EVERY = 50
SHARD_ROWS = 8_192
QUERY_ROWS = 1_024
LEAF = 32
# Of so many shards, one is searched first, for the k-th scores the others start with.
FIRST_OF = 8

# Below every score.
NOTHING = -(2**63)

ANSWER = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Columns ``id``, ``v`` (whole components) and ``dim`` of the rows that take part."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).alias("id"), parts.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("v") > 0) & ~bad)
    return rows.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), F.size("v").alias("dim"))


class BallTree:
    """Points in nodes of a centre, a radius and the smallest id."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self.where: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii, least = [], [], []
        place = np.arange(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            node = len(self.where)
            if parent >= 0:
                kids = list(self.children[parent])
                kids[side] = node
                self.children[parent] = tuple(kids)
            own = self.points[place[a:b]]
            centre = own.mean(axis=0)
            apart = own - centre
            centres.append(centre)
            radii.append(math.sqrt((apart * apart).sum(axis=1).max()))
            least.append(int(self.ids[place[a:b]].min()))
            self.where.append((a, b))
            self.children.append(None)
            if b - a > leaf:
                # Along the widest direction between two far points; ties stay by id.
                far = own[(apart * apart).sum(axis=1).argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                place[a:b] = place[a:b][np.argsort(own @ (other - far), kind="stable")]
                middle = (a + b) // 2
                self.children[node] = (-1, -1)
                todo += [(a, middle, node, 0), (middle, b, node, 1)]
        self.points, self.ids = self.points[place], self.ids[place]
        self.centres, self.radii, self.least = np.array(centres), np.array(radii), least

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No point of a node scores above this whole number, for each query and node."""
        lengths = np.sqrt((queries * queries).sum(axis=1))
        upper = queries @ self.centres.T + np.outer(lengths, self.radii)
        return np.floor(upper + 1e-9 * np.abs(upper) + 1e-6)

    def search(self, query: np.ndarray, bounds: list[float], own_id: int, top: int, kth: int) -> list[tuple[int, int]]:
        """Best (score, id) of this tree, by falling score, then id; scores below ``kth``
        are of no interest."""
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        todo = [(-bounds[0], self.least[0], 0)]
        while todo:
            bound, least, node = heapq.heappop(todo)
            bound = -bound
            full = len(best) == top
            if bound < kth or full and (bound, -least) < best[0]:
                break
            if kids := self.children[node]:
                for kid in kids:
                    heapq.heappush(todo, (-bounds[kid], self.least[kid], kid))
                continue
            a, b = self.where[node]
            scores = self.points[a:b] @ query
            least_score = max(kth, best[0][0]) if full else kth
            for i in np.flatnonzero(scores >= least_score).tolist():
                number = int(self.ids[a + i])
                if number != own_id:
                    heapq.heappush(best, (int(scores[i]), -number))
                    if len(best) > top:
                        heapq.heappop(best)
        return [(int(score), -number) for score, number in sorted(best, reverse=True)]


def _searched(top: int):
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        points = np.array(candidates["v"].tolist(), np.int64)
        asked = np.array(queries["v"].tolist(), np.int64)
        largest = points.shape[1] * math.prod(max(-int(x.min()), int(x.max())) for x in (points, asked))
        if largest >= 2**63:
            raise ValueError("inner products of these vectors may not fit 64 bits")
        if largest < 2**52:  # doubles are exact, and much faster
            points, asked = points.astype(float), asked.astype(float)
        tree = BallTree(points, candidates["id"].to_numpy(np.int64))
        bounds = tree.bounds(asked.astype(float)).tolist()
        rows = []
        for i, (own_id, kth) in enumerate(zip(queries["id"].tolist(), queries["kth"].tolist())):
            rows += [(own_id, number, score) for score, number in tree.search(asked[i], bounds[i], own_id, top, kth)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def _blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def best_by_product(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the best candidates of each query.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = settle(whole_vectors(vectors, key, vector, scale), "vectors")
    queries = rows.filter(is_query).groupBy("id", "dim").agg(F.min("v").alias("v"))
    queries = queries.groupBy("id").agg(F.min(F.struct("dim", "v")).alias("x")).select("id", "x.v", "x.dim")
    queries = settle(queries, "queries")
    shards, blocks = _blocks(rows.count(), shard_rows), _blocks(queries.count(), query_rows)
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sharded = rows.withColumns({"shard": spread(shards), "block": everywhere(blocks)})
    asked = queries.withColumns({"block": spread(blocks), "shard": everywhere(shards)})
    cell = ["dim", "shard", "block"]

    def answers(shard: Column, kth: DataFrame | None) -> DataFrame:
        start = asked.filter(shard)
        start = start.withColumn("kth", F.lit(None)) if kth is None else start.join(kth, "id", "left")
        start = start.select(*cell, "id", "v", F.coalesce(F.col("kth").cast("bigint"), F.lit(NOTHING)).alias("kth"))
        both = sharded.filter(shard).groupBy(*cell).cogroup(start.groupBy(*cell))
        return both.applyInPandas(_searched(top), ANSWER)

    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= top)

    leading = F.col("shard") < F.lit(_blocks(shards, FIRST_OF))
    first = settle(ranked(answers(leading, None)), "first")
    full = first.filter(F.col("rank") == top)
    kth = full.select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    rest = answers(~leading, kth)
    return ranked(first.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")


def every_nth(n: int = EVERY) -> Column:
    return F.pmod(F.col("id"), F.lit(n)) == 0
