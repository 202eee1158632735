"""Centroid clustering by equal-average equal-variance nearest neighbour search.

Lloyd's rounds over whole-number vectors. For each vector the nearest centroid is found
without measuring all: centroids are sorted by the mean of their components, and the scan
starts at the mean of the vector and goes outward. With d components, sums S and deviation
lengths W (d times the sum of squares, less the square of the sum, under the root),

    d * distance >= (S_x - S_c)**2 + (W_x - W_c)**2

holds. Once the first term alone exceeds the best distance so far, so does that of all
centroids further out, and the scan ends (equal average); where both terms exceed it, that
one centroid is passed over (equal variance). What is left is measured exactly, in whole
numbers. Centroids are rejected only if they are farther for certain: an equally near one
may have the smaller number. A task looks at a whole batch of vectors step by step.

Sums are added in tasks first; the driver gets ``clusters * components`` numbers a round
and sends as many out, whatever the number of vectors.

Cases: vectors that are null, of another length, or hold null, NaN or infinite components
take no part. Rows without an id do, but start a cluster only where rows with one are too
few. Equal ids are rows of their own. Fewer vectors than clusters make fewer clusters; an
empty table gives an empty result. Components beyond ``LARGEST`` after scaling have no
exact 64-bit distance: then the query fails and says so. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.workspace import settle

CLUSTERS = 8
ROUNDS = 10
SIZE = 64
SCALE = 1024
SEED = 3
LARGEST = 1 << 27
# Vectors a task looks at together.
TOGETHER = 4_096


@dataclass(frozen=True)
class Search:
    """Centroids sorted by the sum of their components, which is as good as by the mean."""

    centroids: np.ndarray
    number: np.ndarray
    sums: np.ndarray
    lengths: np.ndarray

    @classmethod
    def over(cls, centroids: np.ndarray) -> Search:
        sums = centroids.sum(axis=1)
        order = np.lexsort((np.arange(len(sums)), sums))
        kept = centroids[order]
        return cls(kept, order, sums[order], deviations(kept, sums[order]))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each vector, the smaller
        number of equally near ones; and how many distances were worked out."""
        n, size = vectors.shape
        k = len(self.sums)
        sums = vectors.sum(axis=1)
        lengths = deviations(vectors, sums)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, -1, np.int64)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        active = np.arange(n)
        measured = 0
        while len(active):
            up, down = above[active], below[active]
            far = np.iinfo(np.int64).max
            to_up = np.where(up < k, np.abs(self.sums[np.minimum(up, k - 1)] - sums[active]), far)
            to_down = np.where(down >= 0, np.abs(sums[active] - self.sums[np.maximum(down, 0)]), far)
            go_up = to_up <= to_down
            gap = np.where(go_up, to_up, to_down)
            # Equal average: the nearer of both sides is out of reach, so all others are.
            reach = np.sqrt(best[active].astype(float) * size) * (1 + 1e-12) + 1
            on = (gap < far) & (gap.astype(float) <= reach)
            active, go_up, gap, reach = active[on], go_up[on], gap[on].astype(float), reach[on]
            at = np.where(go_up, above[active], below[active])
            above[active] += go_up
            below[active] -= ~go_up
            # Equal variance, with room for rounding.
            apart = np.abs(lengths[active] - self.lengths[at])
            apart = np.maximum(0.0, apart - 1e-9 * (lengths[active] + self.lengths[at]) - 1e-6)
            near = np.hypot(gap, apart) <= reach
            rows, at = active[near], at[near]
            measured += len(rows)
            difference = vectors[rows] - self.centroids[at]
            distance = np.einsum("ij,ij->i", difference, difference)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]] = distance[better]
            found[rows[better]] = number[better]
        return found, best, measured


def deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Root of size times the sum of squared deviations from the mean, of each vector."""
    means = sums[:, None] / vectors.shape[1]
    apart = vectors - means
    return np.sqrt(np.einsum("ij,ij->i", apart, apart) * vectors.shape[1])


def whole_rows(vectors: DataFrame, key: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``id`` and ``v``, whole components, of the vectors that take part."""
    rows = vectors.select(F.col(key).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter((F.size("v") == size) & ~bad)
    floors = rows.select("id", F.transform("v", lambda x: _bounded(x * scale)).alias("v"))
    return floors


def _bounded(x: Column) -> Column:
    refused = F.raise_error(F.lit(f"a component lies beyond {LARGEST} after scaling")).cast("bigint")
    return F.when(F.abs(x) <= LARGEST, F.floor(x)).otherwise(refused)


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``; equal ids by their components."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")).cast("binary"), 256)
    named = rows.select(F.when(F.col("id").isNotNull(), digest).alias("digest"), "v")
    least = named.orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([row["v"] for row in least], np.int64)


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(batch.num_rows, -1)


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(begin, TOGETHER)
            yield part, _matrix(part, column)


def cluster_sums(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """For each centroid that is nearest to some vector: how many they are, and their sum."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search.over(centroids)
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for _, vectors in _parts(batches, 0):
            nearest, _, _ = search.nearest(vectors)
            order = np.argsort(nearest, kind="stable")
            own, begins = np.unique(nearest[order], return_index=True)
            total[own, 1:] += np.add.reduceat(vectors[order], begins, axis=0)
            total[own, 0] += np.diff(np.append(begins, len(order)))
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"]
        )

    parts = rows.select("v").mapInArrow(added, "cluster int, sums array<bigint>")
    flat = parts.select("cluster", F.posexplode("sums").alias("i", "part"))
    # Decimals: the sum of all tasks may be longer than 64 bits.
    sums = flat.groupBy("cluster", "i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found: dict[int, list[int]] = {}
    for row in sums.orderBy("cluster", "i").collect():
        found.setdefault(row["cluster"], []).append(int(row["total"]))
    return {cluster: (total[0], total[1:]) for cluster, total in found.items()}


def fit_centroids(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids after ``rounds`` rounds over ``rows`` (columns ``id`` and ``v``)."""
    centroids = first_centroids(rows, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, centroids.copy()
        for cluster, (count, total) in cluster_sums(rows, before).items():
            centroids[cluster] = [x // count for x in total]
        if np.array_equal(before, centroids):
            break
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id``, ``cluster`` and squared ``distance`` of each vector."""
    kind = rows.schema["id"].dataType.simpleString()

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search.over(centroids)
        for part, vectors in _parts(batches, 1):
            nearest, distance, _ = search.nearest(vectors)
            columns = [part.column(0), pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return rows.select("id", "v").mapInArrow(assigned, f"id {kind}, cluster int, distance bigint")


def clustered(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """``key``, ``cluster`` and ``distance`` of each vector that takes part, as a written
    table, and the final centroids."""
    rows = settle(whole_rows(vectors, key, vector, size, scale), "vectors")
    centroids = fit_centroids(rows, clusters, rounds, seed)
    if not len(centroids):
        nothing = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return nothing.withColumnRenamed("id", key), centroids
    return settle(assign(rows, centroids), "assigned").withColumnRenamed("id", key), centroids


def centroid_clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", **settings) -> DataFrame:
    """Each vector with its cluster, its distance, the distances summed over its cluster and
    over all, and a digest of the centroid."""
    placed, centroids = clustered(vectors, key, vector, **settings)
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    inertia = {row["cluster"]: row["total"] for row in sums}
    per_cluster = [inertia.get(i, 0) for i in range(len(centroids))]
    written = [",".join(map(str, c.tolist())) for c in centroids]
    of_cluster = lambda values, kind: F.get(_array(values, kind), "cluster")
    return placed.select(
        F.col(key),
        "cluster",
        "distance",
        of_cluster(per_cluster, "bigint").alias("cluster_inertia"),
        F.lit(sum(per_cluster)).cast("bigint").alias("inertia"),
        F.sha2(of_cluster(written, "string"), 256).alias("centroid_sha256"),
    )


def _array(values: list, kind: str) -> Column:
    """One value for each cluster."""
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")
