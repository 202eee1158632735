import random
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from messy import documents, no_documents, prose, texts
from pyspark.sql import functions as F

from tickloom.llm import near_dup
from tickloom.llm.components import components
from tickloom.llm.near_dup import band_keys, bands_of, enough_bands, keep_one_of_each, near_duplicate_classes, once, registers
from tickloom.llm.set_links import links_across, mixed_buckets, prefix_groups, probability_jaccard, set_bytes, shingle_weights
from tickloom.llm.shingles import Shingles, shingles_of, words_of


def shingle_set(text, size=5):
    words = words_of(text).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_classes(rows, least=0.8):
    """Class of each row by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= least:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    names = {r: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for r, m in members.items()}
    return [names[find(i)] for i in range(len(rows))]


def edited(text, edits, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng.random(), 1)
    return " ".join(words)


def group_of_copies(n=60):
    """One text and copies with few and many edits: some alike to it, some to each other."""
    base = prose(11, 150)
    rows = [(i, edited(base, i % 7, i)) for i in range(n)]
    rows += [(n + i, base) for i in range(5)] + [(n + 10 + i, prose(100 + i, 60)) for i in range(10)]
    return rows + [(n + 30, "one two"), (n + 31, "One  two!"), (n + 32, "one")]


def test_classes_equal_those_of_all_pairs(spark, monkeypatch):
    rows = group_of_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == dict(zip((i for i, _ in rows), plain_classes(rows)))


def test_leftover_buckets_are_compared_in_blocks(spark):
    rows = group_of_copies()
    sets = [np.unique(shingles_of([words_of(t)], 5).value.astype(np.uint32)).tobytes() for _, t in rows]
    members = [(7, len(rows), i, i, s) for (i, _), s in zip(rows, sets)]
    df = spark.createDataFrame(members, "bucket bigint, n bigint, node bigint, root bigint, shingles binary")
    for block in (1000, 16):
        links = links_across(df, 0.8, block)
        found = {r.node: r.root for r in components(links, "a", "b").collect()}
        expected = plain_classes(rows)
        assert [found.get(i, i) for i, _ in rows] == expected
        assert links.count() < 6 * len(rows)


def test_registers_agree_as_weighted_sets_do():
    rng = np.random.default_rng(4)
    value = rng.integers(1, 2**48, 300).astype(np.uint64)
    both = Shingles(np.repeat([0, 1], 200), np.concatenate([value[:200], value[100:]]), np.ones(400, int))
    kept = registers(both, 2, 4000)
    assert abs((kept[0] == kept[1]).mean() - 1 / 3) < 0.03
    # A heavy shingle that both have counts for more.
    count = np.ones(400, int)
    count[[150, 250]] = 2**40  # the same shingle in both
    heavy = registers(Shingles(both.owner, both.value, count), 2, 4000)
    weight = 1 + np.log(2.0**40)
    assert abs((heavy[0] == heavy[1]).mean() - (99 + weight) / (299 + weight)) < 0.03


def test_a_repeated_line_in_one_copy_keeps_no_texts_apart(spark):
    rows = []
    for i in range(10):
        base, line = prose(1000 + i, 110), prose(2000 + i, 18)
        rows += [(2 * i, base), (2 * i + 1, "\n".join([base, *[line] * 100]))]
    assert plain_classes(rows) == [i - i % 2 for i, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}
    assert components(df.limit(0), "a", "b").collect() == []


@pytest.mark.parametrize("extra", [False, True])
def test_messy_documents(spark, extra):
    docs = documents(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicate_classes(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.class_id) for r in got))) == sorted(map(str, zip((i for i, _ in rows), plain_classes(rows))))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    # 0 is there twice, 12 copies 11, 6 and 7 are like 5; null without id and text stays.
    assert sorted(i for i, _ in left if i is not None) == [0, 1, 2, 3, 3, 4, 5, 8, 9, 10, 11, 13]
    assert len(left) == 14 and len(texts()) == 14


def test_documents_without_words_are_all_kept(spark):
    rows = [(None, "!!!"), (None, "<<>>"), (None, ""), (None, None), (1, "!!!"), (1, "???"), (1, "one two"), (2, "One two!"), (2, "...")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [(r.doc_id, r.text) for r in keep_one_of_each(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, rows[:7] + rows[8:]))
    assert near_duplicate_classes(docs).filter("is_kept").count() == len(kept)


def test_no_documents(spark):
    assert near_duplicate_classes(no_documents(spark)).collect() == []
    assert keep_one_of_each(no_documents(spark)).collect() == []


def test_large_buckets_meet_by_rare_shingles(spark, monkeypatch):
    """As all pairs, with every bucket of more than four texts taken for a large one."""
    monkeypatch.setattr(near_dup, "LARGE", 4)
    rows = group_of_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == dict(zip((i for i, _ in rows), plain_classes(rows)))


def test_buckets_with_the_same_texts_are_one(spark):
    rows = [(b, n, n % 2) for b in (5, 3, 9) for n in (1, 2, 4)] + [(7, 1, 1), (7, 3, 1), (8, 1, 1), (8, 2, 0)]
    found = mixed_buckets(spark.createDataFrame(rows, "bucket bigint, node bigint, root bigint")).collect()
    assert sorted(map(tuple, found)) == [(3, 3), (8, 2)]


def test_probability_jaccard_equals_its_definition():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint32) for _ in range(2))
        wx, wy = (rng.integers(1, 5, len(s)).astype(np.float32) for s in (x, y))
        left, right = dict(zip(x.tolist(), wx.tolist())), dict(zip(y.tolist(), wy.tolist()))
        expected = sum(
            1 / sum(max(left.get(j, 0) / left[i], right.get(j, 0) / right[i]) for j in left.keys() | right.keys())
            for i in left.keys() & right.keys()
        )
        assert abs(probability_jaccard(x, wx, y, wy) - expected) < 1e-9
    ones = np.ones(20, np.float32)
    assert abs(probability_jaccard(np.arange(20), ones, np.arange(5, 25), ones) - 15 / 25) < 1e-9


def test_texts_that_mostly_repeat_the_same_are_alike(spark):
    """Too different as sets, alike by their weights; and one that shares a line once."""
    line = prose(7000, 60)
    rows = [(i, "\n".join([*[line] * 3000, prose(7100 + i, 18)])) for i in range(4)] + [(9, f"{line} {prose(7200, 40)}")]
    assert len(set(plain_classes(rows))) == 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 9: 9}


def weighted_likeness(a, b, size=5):
    """Probability Jaccard similarity of the shingles of two texts, by its definition."""
    x, y = (Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) for w in (words_of(t).split() for t in (a, b)))
    x, y = ({s: 1 + log(n) for s, n in c.items()} for c in (x, y))
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x.keys() & y.keys())


def chains(n=12, count=2):
    """Texts that repeat a line; by their weights, each is like the one before and the one
    after it alone, and by their sets like none."""
    rows = []
    for c in range(count):
        line, parts = prose(8000 + c, 60), [prose(8100 + 100 * c + i, 30) for i in range(n + 1)]
        rows += [(c * n + i, "\n".join([*[line] * 50, parts[i], parts[i + 1]])) for i in range(n)]
    return rows


def test_chains_are_alike_by_weights_alone():
    rows = chains(4, 1)
    assert len(set(plain_classes(rows))) == 4
    for i, a in rows:
        for j, b in rows[:i]:
            assert (weighted_likeness(a, b) >= 0.8) == (i - j == 1)


@pytest.mark.parametrize("large", [near_dup.LARGE, 4])
def test_leftover_buckets_are_compared_by_weights_as_well(spark, monkeypatch, large):
    """All texts in one bucket, whose centre is like two of them at most."""
    monkeypatch.setattr(near_dup, "LARGE", large)
    rows = chains()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    given = [(i, bytearray(near_dup._key(words_of(t))), [7]) for i, t in rows]
    bucket = spark.createDataFrame(given, "node bigint, key binary, bands array<bigint>")
    roots = near_dup._classes(docs, bucket, "text", 5, 0.8)
    assert {r.node: r.root for r in roots.collect()} == {i: i - i % 12 for i in range(24)}


def test_blocks_and_rare_shingles_by_weights(spark):
    """Chains, and texts that repeat nothing, some of them alike."""
    base = prose(8900, 100)
    rows = chains() + [(100 + i, edited(base, i % 4, i)) for i in range(8)]
    expected = {i: i - i % 12 for i in range(24)}
    expected |= dict(zip((i for i, _ in rows[24:]), plain_classes(rows[24:])))
    found = shingles_of([words_of(t) for _, t in rows], 5)
    sets, weights = set_bytes(found, len(rows)), shingle_weights(found, len(rows))
    given = [(i, i, bytearray(s), bytearray(w)) for (i, _), s, w in zip(rows, sets, weights)]
    frame = spark.createDataFrame(given, "node bigint, root bigint, shingles binary, weights binary")
    whole = frame.withColumns({"bucket": F.lit(7), "n": F.lit(len(rows))})
    rare = prefix_groups(frame, 0.8).join(frame.drop("root"), "node")
    for members, block in ((whole, 1000), (whole, 16), (rare, 1000)):
        links = links_across(members, 0.8, block)
        roots = {r.node: r.root for r in components(links, "a", "b").collect()}
        assert {i: roots.get(i, i) for i, _ in rows} == expected


def test_texts_just_alike_by_weights_share_a_band(spark):
    """Sixty pairs of 0.8 to 0.83; with six bands, one of eleven such pairs shared none."""
    rows = []
    for i in range(60):
        line = prose(9000 + i, 30)
        rows += [(2 * i + k, "\n".join([*[line] * 40, prose(9100 + 2 * i + k, 16)])) for k in (0, 1)]
    assert len(set(plain_classes(rows))) == 120
    assert all(0.8 <= weighted_likeness(rows[i][1], rows[i + 1][1]) < 0.83 for i in range(0, 120, 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == {i: i - i % 2 for i in range(120)}


def test_bands_are_enough_for_the_similarity_asked_for(spark):
    """With 25 bands, two of five pairs that are half alike shared none."""
    assert [(1 - t**5) ** enough_bands(t) <= 1e-9 for t in (0.3, 0.5, 0.8, 0.95, 1)] == [True] * 5
    rows = []
    for i in range(30):
        common = prose(9500 + i, 60)
        rows += [(2 * i + k, f"{common} {prose(9600 + 2 * i + k, 27)}") for k in (0, 1)]
    expected = plain_classes(rows, 0.5)
    assert expected == [i - i % 2 for i, _ in rows] and len(set(plain_classes(rows, 0.55))) == 60
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs, similarity=0.5).collect()}
    assert got == dict(zip((i for i, _ in rows), expected))


def test_bands_of_sets_and_of_weights():
    words = [words_of(t) for t in (prose(1), f"{prose(1)} {prose(2)} {prose(2)} {prose(2)}", "", "a b a b a b a b", prose(3))]
    found = shingles_of(words, 5)
    got = bands_of(found, 5, 12, 5).to_pylist()
    plain = band_keys(registers(once(found), 5, 60), 12, 5)
    heavy = band_keys(registers(found, 5, 60), 12, 5)
    assert all(set(got[i]) == {*plain[i].tolist(), *heavy[i].tolist()} and len(set(got[i])) == len(got[i]) for i in range(5))
    assert len(got[0]) == len(got[4]) == 12 < len(got[1])
