"""Links between sets of shingles that are alike, without comparing all pairs.

Sets are sorted 32-bit numbers, as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tickloom.llm.shingles import Shingles
from tickloom.workspace import settle

# Texts of a group that are compared with as many others at a time.
BLOCK = 512


def set_bytes(shingles: Shingles, texts: int) -> list[bytes]:
    """The set of each text."""
    ends = np.cumsum(np.bincount(shingles.owner, minlength=texts))[:-1]
    return [np.unique(part).tobytes() for part in np.split(shingles.value.astype(np.uint32), ends)]


@F.arrow_udf(DoubleType())
def jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaccard similarity of two sets."""
    found = []
    for a, b in zip(left, right):
        x, y = (np.frombuffer(s.as_buffer(), np.uint32) for s in (a, b))
        both = np.concatenate([x, y])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        found.append(common / (len(both) - common) if len(both) else 0.0)
    return pa.array(found, pa.float64())


def shingle_weights(shingles: Shingles, texts: int) -> list[bytes]:
    """1 + ln(count) of each shingle of ``set_bytes``; nothing where all occur once."""
    ends = np.cumsum(np.bincount(shingles.owner, minlength=texts))[:-1]
    found = []
    for low, count in zip(np.split(shingles.value.astype(np.uint32), ends), np.split(shingles.count, ends)):
        if not len(count) or count.max() == 1:
            found.append(b"")
            continue
        kept, which = np.unique(low, return_inverse=True)
        total = np.bincount(which, count, len(kept))
        found.append((1 + np.log(total)).astype(np.float32).tobytes())
    return found


def probability_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """The sum over common elements i of 1 / sum over j of max(wx_j / wx_i, wy_j / wy_i):
    how often two texts keep the same element in a register of ProbMinHash."""
    _, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(at_x):
        return 0.0
    own_x, own_y = wx[at_x].astype(float), wy[at_y].astype(float)
    order = np.argsort(own_x / own_y, kind="stable")
    own_x, own_y = own_x[order], own_y[order]
    # Of the common ones, those up to i count by the second text, those from i on by the first.
    from_i = np.cumsum(own_x[::-1])[::-1]
    before_i = np.cumsum(own_y) - own_y
    only_x, only_y = wx.sum(dtype=float) - own_x.sum(), wy.sum(dtype=float) - own_y.sum()
    return float((1 / ((from_i + only_x) / own_x + (before_i + only_y) / own_y)).sum())


@F.arrow_udf(DoubleType())
def likeness(left: pa.Array, left_weights: pa.Array, right: pa.Array, right_weights: pa.Array) -> pa.Array:
    """The larger of the Jaccard similarity of two sets and, where a shingle occurs more than
    once, the probability Jaccard similarity of the weighted ones."""
    found = []
    for a, wa, b, wb in zip(left, left_weights, right, right_weights):
        x, y = (np.frombuffer(s.as_buffer(), np.uint32) for s in (a, b))
        both = np.concatenate([x, y])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        alike = common / (len(both) - common) if len(both) else 0.0
        heavy = [np.frombuffer(w.as_buffer(), np.float32) for w in (wa, wb)]
        if alike < 1 and common and (len(heavy[0]) or len(heavy[1])):
            wx, wy = (w if len(w) else np.ones(len(s), np.float32) for w, s in zip(heavy, (x, y)))
            alike = max(alike, probability_jaccard(x, wx, y, wy))
        found.append(alike)
    return pa.array(found, pa.float64())


def _weights(given: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Weights of the shingles of all sets, one set after the other: 1 where there are none."""
    found = [np.frombuffer(w, np.float32) if w else np.ones(n, np.float32) for w, n in zip(given, sizes.tolist())]
    return np.concatenate([np.zeros(0), *found])


def _with_weights(sets: DataFrame) -> DataFrame:
    return sets if "weights" in sets.columns else sets.withColumn("weights", F.lit(None).cast("binary"))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in part.column(2)]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            weights = _weights(part.column(3).to_pylist(), sizes)
            total = np.bincount(np.repeat(np.arange(len(sets)), sizes), weights, len(sets))
            spread = lambda column, sizes=sizes: pa.array(np.repeat(column.to_numpy(), sizes), pa.int64())
            flat = np.concatenate(sets).astype(np.int64)
            columns = [spread(part.column(0)), spread(part.column(1)), pa.array(np.repeat(sizes, sizes)), pa.array(flat)]
            columns += [pa.array(weights), pa.array(np.repeat(total, sizes))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "root", "size", "shingle", "weight", "total"])


def prefix_groups(sets: DataFrame, similarity: float) -> DataFrame:
    """``bucket``, ``n``, ``node``, ``root``: texts that may be alike meet in a bucket.

    ``sets`` has ``node``, ``root``, ``shingles`` and perhaps ``weights``. Let all shingles be
    sorted from the rarest to the most frequent. Of two sets with a Jaccard similarity of t
    or more, the first ``size - ceil(t * size) + 1`` shingles of both share one; so texts meet
    by those alone, and what many texts have in common brings none together as long as they
    have rarer shingles. Of two texts with a probability Jaccard similarity of t or more, the
    common shingles have at least the share t of the weight of either text. So those shingles
    share one that have, with all more frequent ones, at least that share; texts with weights
    meet by those as well. Buckets whose texts have one root are left out.
    """
    given = _with_weights(sets).select("node", "root", "shingles", "weights")
    kinds = "node bigint, root bigint, size bigint, shingle bigint, weight double, total double"
    flat = settle(given.mapInArrow(_elements, kinds), "shingles")
    often = settle(flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")), "often")
    sorted_ = Window.partitionBy("node").orderBy("often", "shingle")
    before = F.sum("weight").over(sorted_.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("weight")
    needed = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - 1e-9) + 1
    first = flat.join(often, "shingle").withColumn("place", F.row_number().over(sorted_)).withColumn("before", before)
    heavy = F.col("total") - F.col("before") >= F.col("total") * (F.lit(similarity) - 1e-6)
    first = first.filter((F.col("place") <= needed) | heavy)
    # A shingle of one text alone brings none together.
    first = first.filter("often > 1")
    first = settle(first.select(F.col("shingle").alias("bucket"), "node", "root"), "prefixes")
    groups = settle(mixed_buckets(first), "groups")
    return first.join(groups, "bucket").select("bucket", "n", "node", "root")


def mixed_buckets(members: DataFrame) -> DataFrame:
    """``bucket`` and ``n`` of buckets whose texts have several roots. Of buckets with the
    same texts, one: what many texts share, they share in many places."""
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark_{i}") for i in (0, 1)]
    roots = [F.min("root").alias("low"), F.max("root").alias("high")]
    groups = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *roots, *marks).filter("low < high")
    return groups.groupBy("n", "mark_0", "mark_1").agg(F.min("bucket").alias("bucket")).select("bucket", "n")


def links_across(members: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between components (``root``) of a bucket of ``n`` texts.

    A bucket is cut into blocks; a task compares two of them at a time, by the places where
    each shingle occurs, and gives back links that connect what was apart, not pairs. With
    ``weights``, texts are compared as by ``likeness``.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = _with_weights(members).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root", "shingles", "weights"
    )

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        both = part["low"].iloc[0] != part["high"].iloc[0]
        sets = [np.frombuffer(x, np.uint32) for x in part["shingles"]]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        owner = np.repeat(np.arange(len(sets)), sizes)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint32)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        places = owner[order]
        nodes, side = part["node"].to_numpy(), part["own"].to_numpy()
        _, group = np.unique(part["root"].to_numpy(), return_inverse=True)
        largest = np.bincount(group).argmax()
        repeats = np.fromiter(map(bool, part["weights"]), bool, len(sets))
        if repeats.any():
            weights = _weights(part["weights"].tolist(), sizes)
            totals, at = np.bincount(owner, weights, len(sets)), np.cumsum(sizes) - sizes
            own = [weights[a : a + n] for a, n in zip(at.tolist(), sizes.tolist())]
            weights = weights[order]
        found = []
        # Pairs inside the largest component need no look; every other pair has a text
        # outside of it.
        for i in np.flatnonzero(group != largest).tolist():
            first, past = np.searchsorted(ordered, sets[i]), np.searchsorted(ordered, sets[i], side="right")
            there = _stretches(first, past)
            common = np.bincount(places[there], minlength=len(sets))
            alike = common / (sizes + sizes[i] - common) >= similarity
            apart = group != group[i]
            if both:
                apart &= side != side[i]
            perhaps = apart & ~alike & (common > 0) & (repeats | repeats[i])
            if perhaps.any():
                most = _most_likely(np.repeat(own[i], past - first), weights[there], places[there], totals[i], totals)
                perhaps &= most >= similarity - 1e-6
            for j in np.flatnonzero(apart & (alike | perhaps)).tolist():
                if group[j] == group[i] or not (alike[j] or probability_jaccard(sets[i], own[i], sets[j], own[j]) >= similarity):
                    continue
                found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
                group[group == group[j]] = group[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket", "low", "high").applyInPandas(compare, "a bigint, b bigint").distinct()


def _most_likely(x: np.ndarray, y: np.ndarray, whose: np.ndarray, total: float, totals: np.ndarray) -> np.ndarray:
    """At least the probability Jaccard similarity of one text and each of several.

    ``x`` and ``y`` are both texts' weights of a common shingle, ``whose`` is the other text.
    """
    only_x = total - np.bincount(whose, x, len(totals))
    only_y = totals - np.bincount(whose, y, len(totals))
    # Of the common shingles, all count by the one text or all by the other.
    parts = np.minimum(1 / (total / x + only_y[whose] / y), 1 / (only_x[whose] / x + totals[whose] / y))
    return np.bincount(whose, parts, len(totals))


def _stretches(first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """All numbers from each first to before each past."""
    sizes = past - first
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
