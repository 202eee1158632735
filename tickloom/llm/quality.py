"""Document quality by co-training.

Two classifiers see different sides of a document: its text (which words and pairs of words
it has, shares of kinds of letters, repeated words and lines, lengths of words and lines)
and its metadata (language, source, declared length). Both begin with labelled documents. In each round, every classifier
labels the documents of which it is sure, and the other one learns from those too. In the
end each is calibrated on labelled documents that none has learnt from, and the calibrated
log-odds of both, less the log-odds of a good document that both contain, score every
document.

Words and pairs of words are hashed to ``2**CONTENT_BITS`` slots each. In how many good and
bad labelled documents a slot occurs, beside how many there are, gives its log-odds; a document's content is the mean of
those of its words, and of its pairs. Labelled documents are counted in two halves, and the
content of one half is judged by the counts of the other, so that no document is judged by
its own words.

Features are worked out once and written, without texts; rounds read only those. Labelled
documents are at most ``LEARN_ROWS``, by a hash of the id; sure documents are all there are.

Cases: null texts have the features of the empty text; null metadata is a value of its own,
and a missing column is null. Rows without an id, or without a label, are scored and may
be learnt from as sure ones. Without good and bad labels, nothing is known, and every score
is 1. Several labels of one id count as the larger one. Equal rows score alike; an empty
table gives an empty one. A column called like the result is replaced.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tickloom.llm.frames import whole
from tickloom.llm.learning import Logistic, fit_logistic, fold_of, label_sample, logistic
from tickloom.llm.shingles import MOST_TEXTS, shingles_of, words_of
from tickloom.llm.workers import begin, hand_back, handed_back, stretches
from tickloom.workspace import settle

LEARN_ROWS = 60_000
CONTENT_BITS = 16
LEAST_DEVIATION = 4.0
ROUNDS = 2
# A classifier is sure of a document beyond this probability, on either side.
SURE = 0.98
# What a sure document weighs, beside 1 for a labelled one.
SURE_WEIGHT = 0.3
# One labelled document in so many serves to calibrate, and none learns from it.
CALIBRATE = 4
GOOD = 0.5
SOURCE_BINS, LANGUAGE_BINS = 32, 16

METADATA = ("lang", "source", "n_chars")
MARKS = re.compile(r"[^\w\s]")
SYMBOLS = re.compile(r"[#$%&*|<>{}\[\]\\^~=+@_]")


def text_features(text: str) -> list[float]:
    """Roots of shares, so that a little differs from nothing, and logarithms of sizes."""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    letters, n, m = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    upper = sum(map(str.isupper, words))
    marked = len(MARKS.findall(text))
    symbols = len(SYMBOLS.findall(text))
    repeated = sum(map(operator.eq, words, words[1:]))
    own = set(words)
    shares = [
        upper / n,
        marked / letters,
        symbols / letters,
        text.count("!") / letters,
        sum(map(str.isdigit, words)) / n,
        repeated / n,
        1 - len(set(lines)) / m,
        # Fewer different words than the usual power of the length.
        max(0.0, 1 - len(own) / n**0.85),
        min(1.0, n / 20),
    ]
    # No length of the whole text: good documents are short and long.
    sizes = [len(text) / n, n / m]
    return [math.sqrt(max(0.0, x)) for x in shares] + [math.log1p(x) for x in sizes]


def content_slots(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different words, or runs of ``size`` words, of some texts: whose, and which slot."""
    found = shingles_of([words_of(x) for x in texts], size)
    return found.owner, (found.value & np.uint64((1 << CONTENT_BITS) - 1)).astype(np.int64)


#: Words, and pairs of words.
CONTENT_SIZES = (1, 2)
# Judged by the counts of both halves.
BOTH = 2


@dataclass(frozen=True)
class Content:
    """Log-odds of a good document by slot: one row for each half that is judged, by the
    other's counts, and their mean for all others; one column of slots after the other."""

    odds: np.ndarray = field(default_factory=lambda: np.zeros((3, len(CONTENT_SIZES) << CONTENT_BITS), np.float32))

    @classmethod
    def of(cls, counts: np.ndarray, documents: np.ndarray) -> Content:
        """From documents with each slot, and documents, by half and label.

        As if one document more had each slot, of average kind. Slots whose share of good
        documents may be chance, being less than ``LEAST_DEVIATION`` standard deviations
        from the average, tell nothing."""
        odds = []
        for half in (1, 0):
            share = (documents[half] + 1) / (documents[half] + 1).sum()
            bad, good = counts[half]
            found = np.log((good + share[1]) / (bad + share[0])) - np.log(share[1] / share[0])
            beyond = np.abs(good - (good + bad) * share[1]) >= LEAST_DEVIATION * np.sqrt((good + bad) * share[0] * share[1])
            odds.append(np.where(beyond & (good + bad > 0), found, 0.0))
        # Others are judged by both alike, on the scale that was learnt.
        return cls(np.array([*odds, (odds[0] + odds[1]) / 2], np.float32))

    def features(self, texts: list[str], halves: np.ndarray) -> np.ndarray:
        """The mean log-odds of the words and of the pairs of each text, 0 without any."""
        columns = []
        for i, size in enumerate(CONTENT_SIZES):
            owner, slot = content_slots(texts, size)
            weight = self.odds[halves[owner], (i << CONTENT_BITS) + slot]
            total, n = np.bincount(owner, weight, len(texts)), np.bincount(owner, minlength=len(texts))
            columns.append(total / np.maximum(1, n))
        return np.stack(columns, axis=1)


def learn_content(labelled: DataFrame) -> Content:
    """From ``text``, ``label`` and ``half`` of the labelled documents. The driver gets at
    most one row for each slot, half and label."""
    width = len(CONTENT_SIZES) << CONTENT_BITS

    @handed_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        # One slot more, for the documents themselves.
        total = np.zeros((4, width + 1), np.int64)
        for batch in batches:
            kinds = batch.column(2).to_numpy() * 2 + (batch.column(1).to_numpy() > 0)
            for at, texts in stretches(batch.column(0), most=MOST_TEXTS):
                kind = kinds[at : at + len(texts)]
                total[:, width] += np.bincount(kind, minlength=4)
                for i, size in enumerate(CONTENT_SIZES):
                    owner, slot = content_slots(texts, size)
                    np.add.at(total, (kind[owner], (i << CONTENT_BITS) + slot), 1)
        kind, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, slot, total[kind, slot])], ["kind", "slot", "n"])

    parts = labelled.select("text", "label", "half").mapInArrow(count, "kind bigint, slot bigint, n bigint")
    sums = parts.groupBy("kind", "slot").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((4, width + 1))
    total[sums["kind"], sums["slot"]] = sums["n"]
    total = total.reshape(2, 2, width + 1)
    return Content.of(total[:, :, :width], total[:, :, width]) if len(sums) else Content()


def _text_view(content: Content, text: Column, half: Column) -> Column:
    """Features of a text: its surface and its content."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def view(texts: pa.Array, halves: pa.Array) -> pa.Array:
        begin("quality")
        parts, of = [], halves.to_numpy(zero_copy_only=False)
        for at, some in stretches(texts, most=MOST_TEXTS):
            own = content.features(some, of[at : at + len(some)])
            both = [[*text_features(x), *c] for x, c in zip(some, own.tolist())]
            parts.append(pa.array(both, pa.list_(pa.float64())))
        hand_back()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return view(text, half)


def metadata_features(df: DataFrame) -> Column:
    """One slot for each bin of languages and sources, and the declared length."""
    there = {name.lower(): name for name in df.columns}

    def value(name: str) -> Column:
        return F.col(there[name]) if name in there else F.lit(None)

    def bins(name: str, n: int) -> list[Column]:
        at = F.pmod(F.xxhash64(F.coalesce(value(name).cast("string"), F.lit("\0"))), F.lit(n))
        return [(at == i).cast("double") for i in range(n)]

    declared = value("n_chars").cast("double")
    known = F.coalesce(F.log1p(F.greatest(declared, F.lit(0.0))), F.lit(0.0))
    return F.array(*bins("lang", LANGUAGE_BINS), *bins("source", SOURCE_BINS), known, declared.isNull().cast("double"))


@dataclass(frozen=True)
class Calibrated:
    """A classifier and the line that turns its log-odds into honest ones."""

    classifier: Logistic
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, features: Column) -> Column:
        return self.shift + self.slope * self.classifier.log_odds(features)


@dataclass(frozen=True)
class QualityModel:
    text: Calibrated | None = None
    metadata: Calibrated | None = None
    prior: float = 0.0
    content: Content = field(default_factory=Content)

    def score(self, text: Column, metadata: Column) -> Column:
        if self.text is None:
            return F.lit(1.0)
        odds = self.text.log_odds(text)
        if self.metadata is not None:
            odds = odds + self.metadata.log_odds(metadata) - self.prior
        return logistic(odds)


def _sure(rows: DataFrame, by: Logistic | None, view: str) -> DataFrame | None:
    """Documents without a label that one classifier is sure of, as the other sees them."""
    if by is None:
        return None
    seen, other = ("text_x", "meta_x") if view == "meta_x" else ("meta_x", "text_x")
    p = logistic(by.log_odds(F.col(seen)))
    y = F.when(p >= SURE, 1.0).when(p <= 1 - SURE, 0.0)
    found = rows.filter("label IS NULL").select(F.col(other).alias("x"), y.alias("y"), F.lit(SURE_WEIGHT).alias("weight"))
    return found.filter("y IS NOT NULL")


def _calibrated(rows: DataFrame, classifier: Logistic, view: str, prior: float) -> Calibrated:
    points = rows.select(F.array(classifier.log_odds(F.col(view))).alias("x"), F.col("label").alias("y"), F.lit(1.0).alias("weight"))
    line = fit_logistic(points, ridge=1e-3)
    if line is None or line.weights[0] <= 0:  # it tells nothing, or the contrary
        return Calibrated(Logistic(), 0.0, prior)
    return Calibrated(classifier, line.weights[0], line.bias)


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", learn_rows: int = LEARN_ROWS, rounds: int = ROUNDS) -> QualityModel:
    """Co-train on all documents, beginning with the labelled ones."""
    # Bounded by learn_rows, so it may be broadcast.
    sample = F.broadcast(label_sample(labels, key, label, learn_rows))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), metadata_features(docs).alias("meta_x"))
    rows = rows.join(sample.select(F.col("key").alias("id"), "label"), "id", "left")
    apart = F.pmod(F.xxhash64(F.lit("calibrate"), F.col("id")), F.lit(CALIBRATE)) == 0
    rows = rows.withColumn("held", F.col("label").isNotNull() & apart)
    taught = F.col("label").isNotNull() & ~F.col("held")
    half = F.pmod(F.xxhash64(F.lit("content"), F.col("id")), F.lit(2)).cast("int")
    content = learn_content(rows.filter(taught).select("text", "label", half.alias("half")))
    own = F.when(taught, half).otherwise(BOTH)
    seen = _text_view(content, F.col("text"), own).alias("text_x")
    rows = settle(rows.select(seen, "meta_x", "label", "held"), "quality")
    teach, held = rows.filter("label IS NOT NULL AND NOT held"), rows.filter("held")

    def fit(view: str, more: DataFrame | None = None, start: Logistic | None = None) -> Logistic | None:
        known = teach.select(F.col(view).alias("x"), F.col("label").alias("y"), F.lit(1.0).alias("weight"))
        return fit_logistic(known if more is None else known.unionByName(more), start=start)

    by_text, by_metadata = fit("text_x"), fit("meta_x")
    if by_text is None or by_metadata is None:
        return QualityModel()
    for _ in range(rounds):
        for_text, for_metadata = _sure(rows, by_metadata, "text_x"), _sure(rows, by_text, "meta_x")
        by_text, by_metadata = fit("text_x", for_text, by_text), fit("meta_x", for_metadata, by_metadata)
    good, n = held.agg(F.sum("label"), F.count("label")).first()
    if not n or not 0 < good < n:  # too few to calibrate
        return QualityModel(Calibrated(by_text), content=content)
    prior = math.log(good / (n - good))
    calibrated = (_calibrated(held, x, view, prior) for x, view in ((by_text, "text_x"), (by_metadata, "meta_x")))
    return QualityModel(*calibrated, prior, content)


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", result: str = "quality_score") -> DataFrame:
    """Add the probability that a document is good."""
    if model.text is None:
        return df.withColumn(result, F.lit(1.0))
    seen = _text_view(model.content, F.col(text), F.lit(BOTH))
    return df.withColumn(result, model.score(seen, metadata_features(df)))
