"""MinHash fingerprints of whole texts, compared with each other and with edited texts.

A fingerprint has ``REGISTERS`` registers. Each belongs to one universal hash function,
``(a * x + b) mod 2**64 >> 32`` with a and b drawn from the seed, applied to the 32-bit
hashes of all shingles at once with numpy, and keeps low bits of the smallest value. The
share of equal registers estimates the Jaccard similarity of the shingle sets.

``near_classes`` finds near duplicates among all texts: bands of registers are joined in
Spark, and pairs that share one are verified by the Jaccard similarity of their whole sets.

``edited_fingerprints`` compares each document with its edited text, whose last half is
replaced by the beginning of the next document. Documents are sorted by id in ranges; a
range also gets the last document of the range before, so a task meets every document
together with its next one while it reads through its range, one Arrow batch at a time.

Cases: null counts as the empty text, which has no shingles; two such texts are alike (1),
one and another text are not (0). Fewer than ``SHINGLE`` words are one shingle. A text
without words is told apart by its signs. Equal ids are ordered by a hash of their texts,
missing ids come after all others; rows equal in both change nothing when they change
places. A single document is its own next one. An empty table gives an empty result.
Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tickloom.llm.components import components
from tickloom.llm.frames import whole
from tickloom.llm.set_links import jaccard, links_across, prefix_groups, set_bytes
from tickloom.llm.shingles import MOST_TEXTS, Shingles, mixed, shingles_of, words_of
from tickloom.workspace import settle

SHINGLE = 5
REGISTERS = 128
BITS = 16
SEED = 12
SIMILARITY = 0.8
BANDS = 25
ROWS = 5
# Letters a task takes at a time, and shingles it hashes at a time (they fit a core's cache).
LETTERS = 500_000
AT_ONCE = 1 << 15


@lru_cache(maxsize=2)
def hash_functions(registers: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    a, b = random.integers(0, 1 << 64, (2, registers), np.uint64, endpoint=False)
    return a | np.uint64(1), b


def text_shingles(texts: list[str], size: int = SHINGLE) -> Shingles:
    """Distinct shingles of some texts; those without words are taken by their signs."""
    words = [words_of(x) or b" ".join(x.encode(errors="replace").split()) for x in texts]
    return shingles_of(words, size)


def signatures(shingles: Shingles, texts: int, registers: int = REGISTERS, seed: int = SEED) -> np.ndarray:
    """The registers of each text as 16-bit numbers, all of them set where it has no shingle."""
    least = np.full((texts, registers), np.iinfo(np.uint64).max, np.uint64)
    a, b = hash_functions(registers, seed)
    x = mixed(shingles.value) >> np.uint64(32)
    for begin in range(0, len(x), AT_ONCE):
        part, owner = x[begin : begin + AT_ONCE], shingles.owner[begin : begin + AT_ONCE]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        own = owner[first]
        for i in range(registers):
            smallest = np.minimum.reduceat(part * a[i] + b[i], first)
            least[own, i] = np.minimum(least[own, i], smallest)
    return (least >> np.uint64(32)).astype(np.uint16)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal registers, row by row."""
    return (left == right).mean(axis=1)


def hexed(registers: np.ndarray) -> list[str]:
    """Registers as text, four hex digits each."""
    return [row.tobytes().hex() for row in registers.astype(">u2")]


def _some(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about ``LETTERS`` letters."""
    begin, letters = 0, 0
    for i, text in enumerate(texts):
        letters += len(text)
        if letters >= LETTERS or i + 1 - begin == MOST_TEXTS or i + 1 == len(texts):
            yield texts[begin : i + 1]
            begin, letters = i + 1, 0


def _signed(texts: list[str], size: int, registers: int, seed: int) -> np.ndarray:
    parts = [signatures(text_shingles(x, size), len(x), registers, seed) for x in _some(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, registers), np.uint16)


def fingerprints(
    docs: DataFrame, text: str = "text", result: str = "fingerprint", size: int = SHINGLE, registers: int = REGISTERS, seed: int = SEED
) -> DataFrame:
    """Add the fingerprint of each text, as hex digits; a column of that name is replaced."""

    @F.arrow_udf("string")
    def signed(texts: pa.Array) -> pa.Array:
        return pa.array(hexed(_signed(texts.to_pylist(), size, registers, seed)), pa.string())

    return docs.withColumn(result, signed(whole(text)))


def edited(own: str, following: str) -> str:
    """A text whose last half, rounded down, is replaced by as much of another, or all."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def _ranges(keys: DataFrame) -> list[tuple]:
    """The last ``id, tie`` of each range of a sort, in order; the driver gets one row for
    each of at most ``spark.sql.shuffle.partitions`` ranges."""
    count = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.repartitionByRange(count, "id", "tie").withColumn("part", F.spark_partition_id())
    last = placed.groupBy("part").agg(F.max(F.struct(F.col("id").isNotNull(), "id", "tie")).alias("last"))
    return [tuple(row["last"]) for row in last.orderBy("part").collect()]


def edited_fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, registers: int = REGISTERS, seed: int = SEED
) -> DataFrame:
    """For each document ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` and, as the share of equal registers, ``near_edited`` (likeness
    to its edited text) and ``near_next`` (to the next document by falling id; after the
    last comes the first)."""
    rows = docs.select(F.col(key).alias("id"), whole(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    # Ranges of ids and hashes only. What follows in falling order comes before in this one.
    lasts = _ranges(rows.select("id", "tie"))
    count = max(1, len(lasts))

    def places(ids: pa.Array, ties: pa.Array) -> pa.Array:
        """The range of each row; for the last row of a range also the one after."""
        found = []
        for number, tie in zip(ids.to_pylist(), ties.to_pylist()):
            row = (number is not None, number, tie)
            at = min(bisect_left(lasts, row), count - 1)
            found.append([at, (at + 1) % count] if lasts[at] == row else [at])
        return pa.array(found, pa.list_(pa.int32()))

    placed = F.arrow_udf(places, ArrayType(IntegerType()))
    spread = rows.select("id", "tie", "text", F.posexplode(placed("id", "tie")).alias("copy", "range"))
    kind = rows.schema["id"].dataType.simpleString()
    together = spread.repartitionById(count, "range").sortWithinPartitions(F.desc("copy"), "id", "tie", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, signed_before = "", np.zeros((1, registers), np.uint16)
        for batch in batches:
            texts, copies = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            if not len(texts):
                continue
            signed = _signed(texts, size, registers, seed)
            previous = [before, *texts[:-1]]
            signed_previous = np.concatenate([signed_before, signed[:-1]])
            before, signed_before = texts[-1], signed[-1:]
            own = np.flatnonzero(copies == 0)
            if not len(own):
                continue
            made = [edited(texts[i], previous[i]) for i in own]
            signed_made = _signed(made, size, registers, seed)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own)),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in made], pa.string()),
                    pa.array(hexed(signed[own]), pa.string()),
                    pa.array(hexed(signed_made), pa.string()),
                    pa.array(likeness(signed[own], signed_made), pa.float64()),
                    pa.array(likeness(signed[own], signed_previous[own]), pa.float64()),
                ],
                [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    columns = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return together.select("id", "text", "copy").mapInArrow(compare, f"`{key}` {kind}, {columns}")


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number for each band of ``rows`` registers of each text."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(registers), bands))
    parts = registers[:, : bands * rows].reshape(len(registers), bands, rows).astype(np.uint64)
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def _banded(size: int, registers: int, seed: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for texts in _some(batch.column(1).to_pylist()):
                found = text_shingles(texts, size)
                keys = band_keys(signatures(found, len(texts), registers, seed), bands, rows)
                sets = set_bytes(found, len(texts))
                same = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in sets]
                ends = pa.array(np.arange(0, keys.size + 1, bands), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(keys.ravel(), pa.int64()))
                ids = batch.column(0).slice(begin, len(texts))
                begin += len(texts)
                columns = [ids, pa.array(same, pa.binary()), pa.array(sets, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "same", "shingles", "bands"])

    return sign


def near_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    size: int = SHINGLE,
    registers: int = REGISTERS,
    seed: int = SEED,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``key`` and ``class_id``, the smallest id of its class, of each document.

    Texts with the same shingles are one text from the start. Texts that share a band are
    compared: first each with the first text of the bucket; where a bucket still holds
    several classes, texts of different classes that share one of their rarest shingles,
    which two texts as alike as ``similarity`` must. A document without shingles is a class
    of its own, named by its own id.
    """
    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("id"), whole(text).alias("text"))
    sign = _banded(size, registers, seed, bands, rows)
    signed = given.mapInArrow(sign, f"id {kind}, same binary, shingles binary, bands array<bigint>")
    signed = settle(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    texts = signed.filter("same IS NOT NULL").groupBy("same").agg(F.min("row").alias("node"))
    texts = settle(texts, "texts")
    distinct = signed.join(texts.select(F.col("node").alias("row")), "row", "left_semi")
    banded = distinct.select(F.col("row").alias("node"), F.explode("bands").alias("bucket"))
    # The first text of each bucket of two or more, worked out in tasks first.
    firsts = banded.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    firsts = settle(firsts.filter("first < last").select("bucket", "first"), "firsts")
    met = settle(banded.join(firsts, "bucket"), "met")
    wanted = met.select(F.col("node").alias("row")).distinct()
    sets = settle(signed.join(wanted, "row", "left_semi").select(F.col("row").alias("node"), "shingles"), "sets")
    stars = met.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    verified = stars.join(right, "b").join(left, "a").filter(jaccard("set_a", "set_b") >= similarity)
    links = settle(verified.select("a", "b"), "links")
    roots = settle(components(links, "a", "b"), "roots")
    placed = settle(_rooted(met, roots), "placed")
    several = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_nodes = placed.join(several.select("bucket"), "bucket", "left_semi").select("node", "root").distinct()
    open_sets = settle(open_nodes.join(sets, "node"), "open")
    more = links_across(prefix_groups(open_sets, similarity).join(open_sets.drop("root"), "node"), similarity)
    roots = settle(components(links.unionByName(settle(more, "links")), "a", "b"), "roots")
    named = _rooted(texts, roots).select("same", "root")
    rooted = signed.select("row", "id", "same").join(named, "same", "left").withColumn("root", F.coalesce("root", -1 - F.col("row")))
    rooted = settle(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("id").alias("class_id"))
    return rooted.join(names, "root").select(F.col("id").alias(key), "class_id")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the ``root`` of ``node``: itself, if it is linked with none."""
    named = roots.select("node", F.col("root").alias("_root"))
    return rows.join(named, "node", "left").select(*(rows[x] for x in rows.columns if x != "node"), rows["node"], F.coalesce("_root", rows["node"]).alias("root"))
