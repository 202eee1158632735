"""A training-data pipeline over ``documents``: five operators, one after the other.

Each stage reads what the one before has written, works on all of it, and returns the
columns of ``documents``; the last returns the encoded documents.

Cases: an empty table, null ids, null or empty texts, repeated rows and further columns go
through every stage, by the rules of its operator. Without labels nothing is rejected;
without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.bpe_codec import bpe_round_trip
from tickloom.llm.decontaminate import clean_documents
from tickloom.llm.frames import free_name, table
from tickloom.llm.near_dup import keep_one_of_each
from tickloom.llm.quality import GOOD, fit_quality, score_quality
from tickloom.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity
from tickloom.workspace import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are rather good than bad."""
    score = free_name(docs, "quality_score")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), result=score)
    return scored.filter(F.col(score) >= GOOD).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    score = free_name(docs, "toxicity")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), result=score)
    return scored.filter(F.col(score) < THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe_round_trip(docs, key="doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", encoding),
]

# The classifiers are trained and the groups are found by hashing, beyond what SQL states;
# tests compare each stage with a plain recomputation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what passes between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
