"""Near-duplicate documents by ProbMinHash.

Every distinct shingle of a document sends arrivals, a Poisson process whose rate is its
weight, each to a random register; a register keeps the shingle that came first. Two
documents agree in a register with the probability Jaccard similarity of their weighted
shingles. A shingle's process ends as soon as its next arrival is later than all registers.
For the bands every distinct shingle has the same weight, so that the registers estimate
the similarity that decides: the Jaccard similarity of the sets, at least ``SIMILARITY``.
However often a line is repeated in one of two texts, that does not keep them apart.
Texts in which a shingle occurs more than once have as many bands of the weighted shingles,
1 + ln(count) each (all others have the same bands either way): two texts that mostly repeat
the same are alike as well, if the probability Jaccard similarity is at least as high.
Registers are banded, in as many bands as it takes that two texts just similar enough share
none of them with a probability of ``MISSED`` at most, by either similarity. Documents that
share a band are compared by their whole shingle sets and weights.

Equal texts (by their words) are one text from the start, however many copies there are.
Texts of a bucket do not meet pair by pair: each is compared with one centre, then with
the centres of its other buckets where they are not connected yet. In buckets that still
hold several components, texts of different components are compared by counting common
shingles, block by block; where such a bucket has more than ``LARGE`` texts, they meet by
their rarest shingles instead, of which two texts as alike as that must share one, however
much the bucket has in common. Either similarity decides, as it does with the centres, so
that no pair is left out. Links come out of that, not pairs.
Since classes are connected components, links inside a component change nothing; none
between components is left out.
Hot buckets and centres are joined with written tables, which Spark can split.

Cases: documents without words (null, empty, signs only) are classes of their own. A text
of fewer than ``SHINGLE`` words is one shingle. Rows that share an id but not the text are
rows of their own; equal rows are copies. A class is named by its smallest id. Rows without
an id are copies and neighbours like others; a class of only such rows has no name. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tickloom.llm.components import components
from tickloom.llm.frames import free_name
from tickloom.llm.set_links import BLOCK, likeness, links_across, mixed_buckets, prefix_groups, set_bytes, shingle_weights
from tickloom.llm.shingles import MOST_TEXTS, Shingles, mixed, shingles_of, words_of
from tickloom.llm.workers import begin, hand_back, handed_back, stretches
from tickloom.workspace import settle

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 5
# How likely two texts that are just similar enough may share no band: as rare as that their
# shingles' hashes clash.
MISSED = 1e-9
# A text of a bucket of n meets n / 512 blocks, or some 32 groups by its rare shingles.
LARGE = 32 * BLOCK


def enough_bands(similarity: float, rows: int = ROWS) -> int:
    """Bands by which texts as similar as that miss each other at most as often as ``MISSED``."""
    if similarity <= 0:
        raise ValueError("similarity must be positive: texts that share nothing meet in no band")
    if similarity**rows >= 1:
        return 1
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-(similarity**rows))))


def registers(shingles: Shingles, texts: int, size: int) -> np.ndarray:
    """ProbMinHash: the shingle that each register of each text keeps (0: no shingle).

    The weight of a shingle is 1 + ln(count)."""
    time = np.full(texts * size, np.inf)
    kept = np.zeros(texts * size, np.uint64)
    owner, value = shingles.owner, shingles.value
    rate = 1 + np.log(shingles.count)
    now = np.zeros(len(owner))
    arrival = 0
    while len(owner):
        arrival += 1
        draw = mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(arrival))
        # The next arrival of each shingle that may still win a register.
        now = now - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate
        slot = owner * size + (mixed(draw) % np.uint64(size)).astype(np.int64)
        np.minimum.at(time, slot, now)
        won = time[slot] == now
        kept[slot[won]] = value[won]
        alive = np.unique(owner)
        latest = np.zeros(texts)
        latest[alive] = time.reshape(texts, size)[alive].max(axis=1)
        go = now < latest[owner]
        owner, value, rate, now = owner[go], value[go], rate[go], now[go]
    return kept.reshape(texts, size)


def once(shingles: Shingles) -> Shingles:
    """Each distinct shingle as if it occurred once, as in the sets that are compared."""
    return replace(shingles, count=np.ones_like(shingles.count))


def band_keys(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number for each band of each text."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(kept), bands))
    parts = kept.reshape(len(kept), bands, rows)
    for i in range(rows):
        key = mixed(key * np.uint64(31) + parts[:, :, i])
    return key.view(np.int64)


def bands_of(found: Shingles, texts: int, bands: int, rows: int) -> pa.ListArray:
    """The bands of each text: those of its set and, where they differ, of its weights."""
    plain = band_keys(registers(once(found), texts, bands * rows), bands, rows)
    keys, own = np.concatenate([plain, plain], axis=1), np.zeros((texts, 2 * bands), bool)
    own[:, :bands] = True
    # Where nothing is repeated, all weights are 1 and the registers are the same.
    repeated = np.unique(found.owner[found.count > 1])
    if len(repeated):
        of = np.isin(found.owner, repeated)
        part = Shingles(np.searchsorted(repeated, found.owner[of]), found.value[of], found.count[of])
        heavy = band_keys(registers(part, len(repeated), bands * rows), bands, rows)
        keys[repeated, bands:] = heavy
        own[repeated, bands:] = heavy != plain[repeated]
    offsets = np.concatenate([[0], np.cumsum(own.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[own], pa.int64()))


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Words of the texts of a batch, some at a time, and the row of the first."""
    for at, texts in stretches(batch.column(column), most=MOST_TEXTS):
        yield at, [words_of(x) for x in texts]


def _key(words: bytes) -> bytes | None:
    return hashlib.blake2b(words, digest_size=16).digest() if words else None


def _signed(shingle: int, bands: int, rows: int):
    @handed_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("near_dup")
        for batch in batches:
            for at, words in _groups(batch, 1):
                found = shingles_of(words, shingle)
                lists = bands_of(found, len(words), bands, rows)
                columns = [batch.column(0).slice(at, len(words)), pa.array(map(_key, words), pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "bands"])

    return sign


def _sets(shingle: int):
    @handed_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("near_dup")
        for batch in batches:
            for _, words in _groups(batch, 0):
                found = shingles_of(words, shingle)
                sets, weights = set_bytes(found, len(words)), shingle_weights(found, len(words))
                columns = [pa.array(x, pa.binary()) for x in (list(map(_key, words)), sets, weights)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "shingles", "weights"])

    return cut


def near_duplicate_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int | None = None,
    rows: int = ROWS,
) -> DataFrame:
    """``key`` and ``class_id`` of each row, and whether it is the row that ``is_kept``.

    Of the rows of a class, one is kept: one of those with the smallest id. Without a number
    of ``bands``, there are ``enough_bands``.
    """
    signed = _signature_rows(docs.select(key, text), key, text, shingle, similarity, bands, rows)
    texts = _distinct_texts(signed)
    roots = _classes(docs.select(text), texts, text, shingle, similarity)
    return _named(signed, texts, roots).select(F.col("id").alias(key), "class_id", "is_kept")


def _signature_rows(
    docs: DataFrame, key: str, text: str, shingle: int, similarity: float, bands: int | None, rows: int
) -> DataFrame:
    """``row`` (a number), ``id``, ``key`` of the words and ``bands`` of each document."""
    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sign = _signed(shingle, enough_bands(similarity, rows) if bands is None else bands, rows)
    signed = given.mapInArrow(sign, f"id {kind}, key binary, bands array<bigint>")
    return settle(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")


def _distinct_texts(signed: DataFrame) -> DataFrame:
    """One row for each text with words: ``node``, ``key``, ``bands``."""
    texts = signed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.first("bands").alias("bands"))
    return settle(texts.withColumn("node", F.monotonically_increasing_id()), "texts")


def _classes(docs: DataFrame, texts: DataFrame, text: str, shingle: int, similarity: float) -> DataFrame:
    """``node`` and ``root`` of the texts that have a near duplicate."""
    banded = texts.select("node", F.explode("bands").alias("bucket"))
    shared = settle(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    met = settle(banded.join(shared, "bucket").select("bucket", "node", "n"), "met")
    # The centre of a bucket meets most texts: what many are copies of is like them all.
    met_by = settle(met.groupBy("node").agg(F.sum("n").alias("meets")), "meets")
    met = settle(met.join(met_by, "node"), "met")
    centre = F.max_by("node", F.struct("meets", F.xxhash64("node"))).alias("centre")
    centres = settle(met.groupBy("bucket").agg(centre, F.max("meets").alias("rank")), "centres")
    members = settle(met.join(centres, "bucket").select("bucket", "n", "centre", "rank", "node"), "members")
    wanted = settle(members.select("node").distinct().join(texts.select("node", "key"), "node"), "wanted")
    given = docs.select(F.col(text).alias("text"))
    cut = given.mapInArrow(_sets(shingle), "key binary, shingles binary, weights binary").filter(F.col("key").isNotNull())
    one = cut.groupBy("key").agg(F.first(F.struct("shingles", "weights")).alias("s"))
    sets = settle(one.join(wanted, "key").select("node", "s.shingles", "s.weights"), "sets")

    def alike(pairs: DataFrame) -> DataFrame:
        """Those pairs ``a, b`` whose sets are similar; ``b`` may be the same very often."""
        left, right = (
            sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"), F.col("weights").alias(f"weights_{x}")) for x in "ab"
        )
        joined = settle(pairs, "pairs").join(right, "b").join(left, "a")
        close = likeness("set_a", "weights_a", "set_b", "weights_b") >= similarity
        return settle(joined.filter(close).select("a", "b"), "links")

    stars = members.filter("node <> centre").groupBy(F.col("node").alias("a"), F.col("centre").alias("b"))
    stars = settle(stars.agg(F.max("rank").alias("rank")), "stars")
    # One centre for each text, the same for many of a group.
    links = alike(stars.groupBy("a").agg(F.max_by("b", F.struct("rank", "b")).alias("b")))
    roots = settle(components(links, "a", "b"), "roots")
    # All other centres, where that may connect what is not connected.
    links = links.unionByName(alike(_apart(stars.select("a", "b"), roots)))
    roots = settle(components(links, "a", "b"), "roots")
    # What is left: buckets with several components. Their texts meet block by block, those
    # of very large ones by rare shingles.
    placed = settle(_rooted(members.select("bucket", "node"), "node", roots), "placed")
    mixed_up = settle(mixed_buckets(placed), "mixed")
    small = placed.join(mixed_up.filter(F.col("n") <= LARGE), "bucket").join(sets, "node")
    large = placed.join(mixed_up.filter(F.col("n") > LARGE), "bucket", "left_semi").select("node", "root").distinct()
    open_sets = settle(large.join(sets, "node"), "open")
    again = prefix_groups(open_sets, similarity).join(sets, "node")
    links = links.unionByName(settle(links_across(small, similarity), "links"))
    links = links.unionByName(settle(links_across(again, similarity), "links"))
    return settle(components(links, "a", "b"), "roots")


def _rooted(rows: DataFrame, node: str, roots: DataFrame) -> DataFrame:
    """Rows with the ``root`` of a node, which is itself if it is connected with none."""
    named = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = rows.join(named, F.col(node) == F.col("_node"), "left")
    return joined.select(*rows.columns, F.coalesce("_root", node).alias("root"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    left = _rooted(pairs, "a", roots).withColumnRenamed("root", "ra")
    return _rooted(left, "b", roots).filter("ra <> root").select("a", "b")


def _named(signed: DataFrame, texts: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the name of their class and whether they are kept."""
    rooted = settle(_rooted(texts.select("node", "key"), "node", roots).select("key", "root"), "rooted")
    rows = signed.select("row", "id", "key").join(rooted, "key", "left")
    # Without words: a class of its own, told by the row.
    rows = settle(rows.withColumn("root", F.coalesce("root", -1 - F.col("row"))), "rows")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    names = settle(rows.groupBy("root").agg(first), "names")
    named = rows.join(names, "root")
    return named.select("row", "id", F.col("first.id").alias("class_id"), (F.col("row") == F.col("first.row")).alias("is_kept"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents without near duplicates: one of each class, all columns as they are.

    Rows are told apart by id and words; of several with the same, one is kept. Documents
    without words are all kept, as each is a class of its own. The documents themselves are
    exchanged once; only rows that share id and words with another one are looked at again.
    """
    signed = _signature_rows(docs.select(key, text), key, text, **settings_of(settings, "shingle", "similarity", "bands", "rows"))
    texts = _distinct_texts(signed)
    roots = _classes(docs.select(text), texts, text, **settings_of(settings, "shingle", "similarity"))
    named = _named(signed, texts, roots).select("row", "is_kept")
    worded = signed.filter(F.col("key").isNotNull()).select("row", "id", "key").join(named, "row")
    kept_of = worded.groupBy("id", "key").agg(F.max("is_kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = settle(kept_of.filter(~F.col("kept") | (F.col("n") > 1)).select("id", "key", "kept"), "odd")
    words, own_id, own_key, own_kept = (free_name(docs, x) for x in ("words_key", "odd_id", "odd_key", "odd_kept"))
    same = F.col(key).eqNullSafe(F.col(own_id)) & (F.col(words) == F.col(own_key))
    marked = docs.withColumn(words, words_key(F.col(text))).join(odd.toDF(own_id, own_key, own_kept), same, "left")
    left = marked.filter(F.col(own_kept).isNull() | F.col(own_kept))
    if odd.filter("kept").isEmpty():
        return left.select(*docs.columns)
    alone = left.filter(F.col(own_kept).isNull())
    once = left.filter(F.col(own_kept)).dropDuplicates([key, words])
    return alone.unionByName(once).select(*docs.columns)


DEFAULTS = {"shingle": SHINGLE, "similarity": SIMILARITY, "bands": None, "rows": ROWS}


def settings_of(given: dict, *names: str) -> dict:
    return {name: given.get(name, DEFAULTS[name]) for name in names}


@F.arrow_udf(BinaryType())
def words_key(texts: pa.Array) -> pa.Array:
    """What texts with the same words share; null without words."""
    found = [_key(words_of(x)) for _, some in stretches(texts) for x in some]
    hand_back()
    return pa.array(found, pa.binary())
