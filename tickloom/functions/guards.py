"""Checks on a frame before work starts."""

from __future__ import annotations

from pyspark.sql import DataFrame


class EmptyInputError(ValueError):
    """The input holds no rows."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when there is no row. Reads until the first row, never counts."""
    if df.isEmpty():
        raise EmptyInputError(f"no rows in {what}")
    return df
