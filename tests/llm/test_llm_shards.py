import zlib
from collections import Counter

import numpy as np
from messy import documents, no_documents
from pyspark.sql import functions as F

from tickloom.llm import shards as shards_module
from tickloom.llm.shards import draw_counts, exact_shuffle, hypergeometric, permuted, placed_texts, write_shards


def test_permutations_are_permutations():
    for n in (1, 2, 3, 5, 64, 1000):
        for key in (0, 17):
            assert sorted(permuted(np.arange(n), np.full(n, n), np.full(n, key))) == list(range(n))


def test_draws_follow_the_law():
    random = np.random.default_rng(1)
    own = [hypergeometric(random, 30, 70, 20) for _ in range(20_000)]
    other = random.hypergeometric(30, 70, 20, 20_000)
    assert abs(np.mean(own) - 6) < 0.05 and abs(np.var(own) - np.var(other)) < 0.15
    large = hypergeometric(random, 10**11, 10**12, 10**7)
    assert abs(large - 10**7 / 11) < 5000


def test_counts_fit_rows_and_shards():
    for rows, quotas in (([5, 0, 7], [4, 4, 4]), ([1], [1, 0]), ([], [0, 0]), ([100] * 9, [300, 600])):
        drawn = draw_counts(rows, quotas, np.random.default_rng(2))
        assert drawn.sum(axis=1).tolist() == rows and (not rows or drawn.sum(axis=0).tolist() == quotas)


def test_shards_are_exact_and_gapless(spark):
    df = spark.range(1003).repartition(7)
    rows = exact_shuffle(df, shards=10, seed=3).collect()
    assert sorted(r.id for r in rows) == list(range(1003))
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_the_shuffle_looks_uniform(spark):
    rows = exact_shuffle(spark.range(4000).repartition(4), shards=4, seed=9).collect()
    quarter = Counter((r.id // 1000, r.shard) for r in rows)
    assert all(200 < n < 300 for n in quarter.values())
    order = [r.id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(order, range(4000))[0, 1]) < 0.06


def test_messy_documents(spark):
    docs = documents(spark, extra=True)
    rows = placed_texts(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"rows"}
    nothing = [r for r in rows if r["size"] == 8]
    assert nothing and all(r.text_crc32 == 0 for r in nothing)
    kept = exact_shuffle(docs, shards=3)
    assert set(kept.columns) == set(docs.columns) and kept.count() == docs.count()
    assert placed_texts(no_documents(spark)).collect() == []


def test_files_are_in_order(spark, tmp_path):
    write_shards(spark.range(50), str(tmp_path / "s"), shards=3)
    read = spark.read.parquet(str(tmp_path / "s"))
    assert read.count() == 50 and read.select("shard").distinct().count() == 3


def test_the_texts_themselves_are_shuffled(spark, monkeypatch):
    given = []
    monkeypatch.setattr(shards_module, "exact_shuffle", lambda df, *rest: given.append(df) or exact_shuffle(df, *rest))
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(30)], "doc_id bigint, text string, lang string")
    rows = placed_texts(docs, shards=3).collect()
    assert given[0].columns == docs.columns
    assert {r.doc_id: r.text_crc32 for r in rows} == {i: zlib.crc32(f"text {i}".encode()) for i in range(30)}


def test_long_rows_make_small_blocks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i, "x" * 1000) for i in range(64)], "i int, text string")
        put = exact_shuffle(df, shards=1, block_bytes=5000).withColumn("task", F.spark_partition_id()).collect()
        assert len({r.task for r in put}) > 1 and sorted(r.slot for r in put) == list(range(64))
        # Four rows in a block, all of them in one task.
        assert all(len({r.task for r in put if r.slot // 4 == k}) == 1 for k in range(16))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
