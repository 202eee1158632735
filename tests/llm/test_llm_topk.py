import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm.topk import best_by_product, every_nth

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_best(rows, top, n):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in sorted(whole):
        if i % n == 0:
            asked.setdefault(i, v)
    result = set()
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        result |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:top], 1)}
    return result


def some_vectors(n, dim, same=0):
    rng = random.Random(n)
    rows = [(i, [rng.choice([rng.gauss(0, 0.2), 0.0]) for _ in range(dim)], 0) for i in range(n)]
    return [(i, rows[0][1], 0) if i % 3 == 0 and same else row for i, row in enumerate(rows)]


@pytest.mark.parametrize("same", [0, 1])
def test_equals_all_products(spark, same):
    rows = some_vectors(300, 8, same)
    df = spark.createDataFrame(rows, SCHEMA)
    # Doubles of what is stored as float.
    stored = [tuple(r) for r in df.collect()]
    got = best_by_product(df, every_nth(20), shard_rows=64, query_rows=4)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == plain_best(stored, 5, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.25], 1), (50, None, 1), (100, [], 1), (150, [nan, 0.0], 1), (200, [inf, 0.0], 1), (250, [None, 0.1], 1),
        (1, [0.5, 0.25], 1), (1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1), (3, [1.0, 1.0, 1.0], 1), (None, [9.0, 9.0], 1), (0, [0.5, 0.25], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("x")).withColumn("id", F.lit(1))
    got = sorted(tuple(r) for r in best_by_product(df, every_nth()).collect())
    score = 128 * 128 + 64 * 64
    assert got == [(0, 1, 1, score), (0, 2, 1, score), (0, 3, 2, score)]


def test_large_components_are_exact(spark):
    rows = [(0, [1_000_000.0, 3.0], 0), (1, [1_000_000.0, 1.0], 0), (2, [1_000_000.0, 2.0], 0)]
    got = best_by_product(spark.createDataFrame(rows, SCHEMA), every_nth()).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 256**2 * (10**12 + 6)), (1, 256**2 * (10**12 + 3))]


def test_no_vectors(spark):
    assert best_by_product(spark.createDataFrame([], SCHEMA), every_nth()).collect() == []


def test_products_beyond_64_bits_are_refused(spark):
    rows = [(0, [1e18, 1.0]), (1, [1e18, 2.0]), (2, [1.0, 1.0])]
    huge = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        best_by_product(huge, every_nth()).collect()
    large = spark.createDataFrame([(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [1.0, 1.0])], huge.schema)
    found = best_by_product(large, every_nth(), top=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, (3 * 256 * 10**6) ** 2 + 2 * 256**2), (2, 3 * 256**2 * 10**6 + 256**2)]
