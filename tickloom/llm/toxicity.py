"""Toxicity by weak supervision.

1. Lexicons are mined from labelled documents of the learning folds: words and beginnings
   of words that occur far more often in toxic ones than chance allows, after many
   different words (so that copies of one document do not make its words toxic).
2. Entries are dealt into several lexicon voters; others vote on how many entries there
   are and on patterns (shouting, masked words and the like). Each votes on every
   document of the learning folds.
3. A generative label model is fitted to the votes alone by expectation maximisation: for
   each voter how often it votes on toxic and on other documents, and for each pair how
   far they agree beyond that; voters that repeat each other count less. Only distinct
   vote patterns reach the driver, at most ``2 ** VOTERS``.
4. A logistic classifier on counts of hits is trained on the posterior labels of all those
   documents. It scores whole texts, whoever they are from.

``LEARN_ROWS`` bounds the labelled rows lexicons are mined from, ``ENTRIES`` the entries.
Language, source, ids and labels are no inputs of a score.

Cases: null scores like the empty text, whose features are all zero. Rows without an id
are scored and never learnt from. Without toxic labels nothing is known and all scores are
0. Equal texts score alike; an empty table gives an empty one. A column of the input called
like the result is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.learning import Logistic, fit_logistic, fold_of, label_sample
from tickloom.llm.workers import begin, hand_back, handed_back, stretches
from tickloom.workspace import settle

FOLDS, HELD_OUT = 3, 1
LEARN_ROWS = 50_000
THRESHOLD = 0.7

# What an entry of the lexicon needs: toxic documents, different words before it, and how
# many standard deviations it is beyond its share by chance.
LEAST_DOCUMENTS, LEAST_CONTEXTS, LEAST_DEVIATION, LEAST_SHARE = 3, 4, 4.0, 0.6
BEGINNINGS = (4, 5, 6)
# Beginnings count where so many different words of a document begin so.
LEVELS = (1, 2, 3)
WORD_VOTERS, PER_LEVEL = 6, 2
BEGINNING_VOTERS = PER_LEVEL * len(LEVELS)
# A task hands on its counts when they are more than this.
HELD_COUNTS = 400_000

WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[*@#$%]{2,}")
ADDRESS = frozenset("you your yours du dein deine toi ton ta tu tus tú usted".split())
#: Pattern voters, with the share of words each votes from: shouting, words in capitals,
#: masked words, addressing the reader.
PATTERNS = {"shouts": 0.002, "capitals": 0.05, "masked": 0.002, "address": 0.02}
AMOUNT_VOTERS = 3
VOTERS = WORD_VOTERS + BEGINNING_VOTERS + AMOUNT_VOTERS + len(PATTERNS)
LEXICON_VOTERS = WORD_VOTERS + BEGINNING_VOTERS


def learns(key: str | Column) -> Column:
    """Whether labels of this row may be learnt from."""
    return F.coalesce(fold_of(key, FOLDS) != HELD_OUT, F.lit(False))


# --- lexicons ----------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From text and label: documents of each kind by entry, and what stands before."""
    toxic, clean, before = Counter(), Counter(), set()

    def flush() -> pa.RecordBatch:
        entries = list(toxic.keys() | clean.keys())
        pairs = list(before)
        none = [None] * len(entries)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(entries + [e for e, _ in pairs], pa.string()),
                pa.array(none + [b for _, b in pairs], pa.int64()),
                pa.array([toxic[e] for e in entries] + [0] * len(pairs), pa.int64()),
                pa.array([clean[e] for e in entries] + [0] * len(pairs), pa.int64()),
            ],
            ["entry", "before", "toxic", "clean"],
        )
        toxic.clear(), clean.clear(), before.clear()
        return batch

    begin("toxicity")
    for text, label in _rows(batches):
        words = WORD.findall(text.lower())
        own = set(words)
        begun = Counter(w[:n] for w in own for n in BEGINNINGS if len(w) > n)
        entries_of = {b: [f"{b}*{level}" for level in LEVELS if n >= level] for b, n in begun.items()}
        entries = own.union(*entries_of.values())
        if label:
            toxic.update(entries)
            for previous, word in zip(["", *words], words):
                mark = xxhash.xxh32_intdigest(previous)
                before.add((word, mark))
                for n in BEGINNINGS:
                    if len(word) > n:
                        before.update((entry, mark) for entry in entries_of[word[:n]])
        else:
            clean.update(entries)
        if len(toxic) + len(clean) + len(before) > HELD_COUNTS:
            yield flush()
    yield flush()
    hand_back()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool]]:
    for batch in batches:
        for at, some in stretches(batch.column(0)):
            yield from zip(some, batch.column(1).slice(at, len(some)).to_pylist())


def mine_lexicon(labelled: DataFrame, text: str, label: str) -> list[str]:
    """Entries of toxic documents, the strongest first; beginnings end with a star and
    the number of different words a document must have of them."""
    rows = labelled.select(text, label)
    counts = rows.mapInArrow(_counted, "entry string, before bigint, toxic bigint, clean bigint")
    sums = counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_distinct("before").alias("contexts"))
    size = {bool(y): n for y, n in rows.groupBy(label).count().collect()}
    if not size.get(True):
        return []
    share = size[True] / sum(size.values())
    expected = (F.col("toxic") + F.col("clean")) * share
    deviation = (F.col("toxic") - expected) / F.sqrt(expected * max(1 - share, 0.05))
    kept = sums.filter(
        (F.col("toxic") >= LEAST_DOCUMENTS)
        & (F.col("contexts") >= LEAST_CONTEXTS)
        & (deviation >= LEAST_DEVIATION)
        & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean")))
    )
    # As many as are significant: the labelled rows, which are bounded, bound them.
    best = kept.orderBy(F.desc(deviation), "entry")
    return [row["entry"] for row in best.select("entry").collect()]


@dataclass(frozen=True)
class Lexicon:
    """Entries and the voter each belongs to; for beginnings, one for each level."""

    words: dict[str, int] = field(default_factory=dict)
    beginnings: dict[str, dict[int, int]] = field(default_factory=dict)
    starts: frozenset[str] = frozenset()

    @classmethod
    def of(cls, entries: list[str]) -> Lexicon:
        # The strongest first, so that voters differ in how far they can be trusted.
        words = [e for e in entries if "*" not in e]
        beginnings: dict[str, dict[int, int]] = {}
        for at, level in enumerate(LEVELS):
            begins = [e.split("*")[0] for e in entries if e.endswith(f"*{level}")]
            for i, begin in enumerate(begins):
                voter = WORD_VOTERS + PER_LEVEL * at + i * PER_LEVEL // len(begins)
                beginnings.setdefault(begin, {})[level] = voter
        return cls({w: i * WORD_VOTERS // len(words) for i, w in enumerate(words)}, beginnings, frozenset(b[: BEGINNINGS[0]] for b in beginnings))

    def features(self, text: str) -> tuple[np.ndarray, int]:
        """Features of the classifier, and the votes as bits."""
        words = WORD.findall(text.lower())
        own, n = set(words), max(1, len(words))
        per_voter = [0] * LEXICON_VOTERS
        hit = own & self.words.keys()
        for word in hit:
            per_voter[self.words[word]] += 1
        shortest = BEGINNINGS[0]
        begun: dict[str, list[str]] = {}
        for word in own:
            if word[:shortest] in self.starts:
                for size in BEGINNINGS:
                    if len(word) > size and word[:size] in self.beginnings:
                        begun.setdefault(word[:size], []).append(word)
        for begin, found in begun.items():
            for level, voter in self.beginnings[begin].items():
                if len(found) >= level:
                    per_voter[voter] += len(found)
                    hit.update(found)
        distinct, total = len(hit), sum(map(words.count, hit))
        shares = [
            text.count("!!") / n,
            sum(map(str.isupper, text.split())) / n,
            len(MASKED.findall(text)) / n,
            sum(map(words.count, own & ADDRESS)) / n,
        ]
        votes = [*(x > 0 for x in per_voter), distinct >= 2, total >= 4, total > 0 and total >= 0.01 * n]
        votes += [share >= least for share, least in zip(shares, PATTERNS.values())]
        counts = np.log1p([*per_voter, distinct, total])
        return np.array([*counts, 100 * total / n, *shares]), sum(1 << i for i, vote in enumerate(votes) if vote)


# --- label model -------------------------------------------------------------------------


@dataclass
class LabelModel:
    """How often each voter votes on toxic and on other documents, how far voters agree
    beyond that, and what each one's vote counts."""

    prior: float
    rates: np.ndarray
    correlation: np.ndarray
    counts: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = votes[:, :, None] * np.log(self.rates) + (1 - votes[:, :, None]) * np.log(1 - self.rates)
        odds = (log * self.counts[None, :, None]).sum(axis=1)
        odds = odds[:, 1] - odds[:, 0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_label_model(votes: np.ndarray, n: np.ndarray, rounds: int = 4, steps: int = 60) -> LabelModel:
    """Expectation maximisation over distinct vote patterns that occur ``n`` times.

    It begins with the share of lexicon voters that vote. After each round the agreement
    of voters within a class is measured, and a voter counts the less the more others
    repeat it.
    """
    votes, n = votes.astype(float), n.astype(float)
    lexicon = votes[:, :LEXICON_VOTERS].mean(axis=1)
    toxic = np.clip(0.02 + 1.5 * lexicon, 0.02, 0.98)
    model = LabelModel(0.5, np.zeros((votes.shape[1], 2)), np.eye(votes.shape[1]), np.ones(votes.shape[1]))
    for _ in range(rounds):
        for _ in range(steps):
            mass = np.stack([n * (1 - toxic), n * toxic])
            model.prior = float(np.clip(mass[1].sum() / n.sum(), 1e-4, 0.9))
            model.rates = ((mass @ votes + 0.05) / (mass.sum(axis=1, keepdims=True) + 0.1)).T.clip(1e-4, 1 - 1e-4)
            before, toxic = toxic, model.posterior(votes)
            if np.abs(toxic - before).max() < 1e-6:
                break
        agreement = np.zeros((votes.shape[1],) * 2)
        for kind, weight in enumerate((n * (1 - toxic), n * toxic)):
            apart = votes - model.rates[:, kind]
            covariance = (apart * weight[:, None]).T @ apart / max(weight.sum(), 1e-9)
            spread = np.sqrt(np.diag(covariance).clip(1e-9))
            agreement += covariance / np.outer(spread, spread) * (weight.sum() / n.sum())
        model.correlation = agreement
        others = (np.abs(agreement) - np.eye(len(agreement))).clip(0.05) - 0.05
        model.counts = 1 / (1 + others.sum(axis=1))
    return model


# --- classifier --------------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon = Lexicon()
    classifier: Logistic | None = None

    def scores(self, texts: list[str]) -> list[float]:
        if self.classifier is None:
            return [0.0] * len(texts)
        weights, bias = np.array(self.classifier.weights), self.classifier.bias
        odds = [float(weights @ self.lexicon.features(text)[0]) + bias for text in texts]
        return (1 / (1 + np.exp(-np.clip(odds, -500, 500)))).tolist()


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", learn_rows: int = LEARN_ROWS) -> ToxicityModel:
    """Learn from the rows that ``learns`` allows: lexicons from labels, the rest without."""
    # Bounded by learn_rows, so it may be broadcast.
    sample = F.broadcast(label_sample(labels, key, label, learn_rows, learns(key)))
    rows = docs.filter(learns(key)).select(F.col(key).alias("id"), F.col(text).alias("text"))
    labelled = rows.join(sample, F.col("id") == F.col("key")).select("text", (F.col("label") > 0).alias("toxic"))
    lexicon = Lexicon.of(mine_lexicon(labelled, "text", "toxic"))
    if not lexicon.words and not lexicon.beginnings:
        return ToxicityModel()

    @handed_back
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        for batch in batches:
            found = [lexicon.features(x) for _, some in stretches(batch.column(0)) for x in some]
            columns = [pa.array([v for _, v in found], pa.int64()), pa.array([x.tolist() for x, _ in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["votes", "x"])

    voted = settle(rows.select("text").mapInArrow(vote, "votes bigint, x array<double>"), "votes")
    patterns = voted.groupBy("votes").count().orderBy("votes").collect()
    bits = np.array([[row["votes"] >> i & 1 for i in range(VOTERS)] for row in patterns])
    model = fit_label_model(bits, np.array([row["count"] for row in patterns]))
    posterior = zip((row["votes"] for row in patterns), model.posterior(bits).tolist())
    # At most one row for each pattern of votes.
    labels_of = F.broadcast(docs.sparkSession.createDataFrame(list(posterior), "votes bigint, p double"))
    both = F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("weight")))
    rows = voted.join(labels_of, "votes").select("x", F.explode(both).alias("z")).select("x", "z.y", "z.weight")
    return ToxicityModel(lexicon, fit_logistic(rows.filter("weight > 0.0001"), ridge=1e-4))


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", result: str = "toxicity") -> DataFrame:
    """Add the score of each whole text, from 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        begin("toxicity")
        found = [score for _, some in stretches(texts) for score in model.scores(some)]
        hand_back()
        return pa.array(found, pa.float64())

    return df.withColumn(result, scored(F.col(text)))
