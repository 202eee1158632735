import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.centroids import CLUSTERS, LARGEST, Search, centroid_clusters, clustered

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, id int, v string"


def rows(n, seed, size=64, spread=1.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(5, size))
    return [(i, (centres[i % 5] * spread + random.normal(size=size) * 0.3).astype(np.float32).tolist(), "x", 1, "y") for i in range(n)]


def plain(kept, clusters=8, rounds=10, seed=3, scale=1024):
    """All distances, in Python's whole numbers."""
    order = sorted(kept, key=lambda r: hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest())
    vectors = {r[0]: [int(np.floor(scale * float(np.float32(x)))) for x in r[1]] for r in kept}
    centroids = [vectors[r[0]] for r in order[:clusters]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((distance(v, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for v in vectors.values():
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g)] if (g := groups.get(i)) else c for i, c in enumerate(centroids)]
    placed = {k: nearest(v) for k, v in vectors.items()}
    inertia = [sum(d for d, i in placed.values() if i == c) for c in range(len(centroids))]
    return {
        (k, i, d, inertia[i], sum(inertia), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest())
        for k, (d, i) in placed.items()
    }


def test_equals_all_distances(spark):
    given = rows(300, 1)
    found = centroid_clusters(spark.createDataFrame(given, SCHEMA).repartition(5))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert {tuple(r) for r in found.collect()} == plain(given)


def test_search_is_exact_and_measures_less():
    random = np.random.default_rng(4)
    vectors = random.integers(-500, 500, (2000, 64)) + random.integers(-300, 300, (2000, 1))
    centroids = vectors[:64].copy()
    centroids[40] = centroids[7]  # equally near: the smaller number
    number, distance, measured = Search.over(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 0.8 * every.size


def test_ties_flat_vectors_and_large_components():
    flat = np.repeat(np.arange(-5, 6)[:, None], 64, axis=1)
    number, distance, _ = Search.over(flat[::2]).nearest(flat)
    every = ((flat[:, None] - flat[::2][None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    large = np.array([[LARGEST] * 64, [-LARGEST] * 64, [LARGEST - 1] * 64])
    number, distance, _ = Search.over(large[:2]).nearest(large)
    assert number.tolist() == [0, 1, 0] and distance.tolist() == [0, 0, 64]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = rows(40, 2)
    odd = [
        (100, None, "x", 1, "y"), (101, [], "x", 1, "y"), (102, [1.0] * 63, "x", 1, "y"), (103, [1.0] * 65, "x", 1, "y"),
        (104, [None] + [1.0] * 63, "x", 1, "y"), (105, [nan] * 64, "x", 1, "y"), (106, [inf] + [0.0] * 63, "x", 1, "y"),
    ]
    found = centroid_clusters(spark.createDataFrame([*good, *odd], SCHEMA)).collect()
    assert {tuple(r) for r in found} == plain(good)
    # Rows without an id and repeated rows take part, each as a row.
    again = spark.createDataFrame([*good, good[0], (None, good[1][1], None, None, None)], SCHEMA)
    rows_of = centroid_clusters(again).collect()
    assert len(rows_of) == 42 and len({tuple(r) for r in rows_of if r.vec_id == good[0][0]}) == 1


def test_few_vectors_and_none(spark):
    few = rows(3, 3)
    found, centroids = clustered(spark.createDataFrame(few, SCHEMA))
    assert len(centroids) == 3 < CLUSTERS and {r.distance for r in found.collect()} == {0}
    empty = centroid_clusters(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.schema["distance"].dataType.simpleString() == "bigint"


def test_components_without_exact_distance_are_refused(spark):
    huge = spark.createDataFrame([(1, [1e30] * 64, None, None, None)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        centroid_clusters(huge).collect()


def test_empty_clusters_stay(spark):
    same = spark.range(20).select(F.col("id").alias("vec_id"), F.array(*[F.lit(0.5).cast("float")] * 64).alias("embedding"))
    found, centroids = clustered(same)
    assert {r.cluster for r in found.collect()} == {0} and len(centroids) == 8
