"""Figures about one column, and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import require_columns


def column_profile(df: DataFrame, column: str = "age") -> DataFrame:
    """Mean, maximum and number of values of a column that must exist."""
    require_columns(df, column)
    return df.select(
        F.avg(column).alias(f"avg_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.count(column).alias("count_rows"),
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def max_by_key(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(column).alias(name))


def preview(df: DataFrame, rows: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows; with an order they are always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def row_total(df: DataFrame) -> DataFrame:
    """The number of rows as a one-row frame."""
    return df.agg(F.count("*").alias("row_total"))
