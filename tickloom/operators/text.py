"""Words of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(lines: DataFrame, column: str = "line") -> DataFrame:
    """One row per word. Every single space splits, so empty words are kept."""
    return lines.select(F.explode(F.split(column, " ")).alias("word"))


def word_count(lines: DataFrame, column: str = "line") -> DataFrame:
    return words(lines, column).groupBy("word").count()
