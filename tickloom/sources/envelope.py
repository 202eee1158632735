"""Landed answers of the ridership service: one JSON envelope per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import RIDERSHIP_ENVELOPE

def read_envelopes(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """One row per landed answer. A file holds one answer, on any number of lines; or,
    with ``one_per_file=False``, one answer per line, and then large files are split."""
    reader = spark.read.schema(RIDERSHIP_ENVELOPE).option("multiLine", one_per_file)
    return reader.json(path)


def accepted_envelopes(envelopes: DataFrame) -> DataFrame:
    """Drop answers whose result code reports an error."""
    code = F.col("CardSubwayStatsNew.RESULT.CODE")
    return envelopes.filter(~code.contains("ERROR"))


def envelope_rows(envelopes: DataFrame) -> DataFrame:
    """The items of all accepted answers."""
    return accepted_envelopes(envelopes).selectExpr("inline(CardSubwayStatsNew.row)")
