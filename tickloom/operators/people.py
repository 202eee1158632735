"""The people sample: initials and an age limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import initial


def with_initial(people: DataFrame, column: str = "name") -> DataFrame:
    return people.withColumn("initial", initial(column))


def older_than(people: DataFrame, age: float = 26, column: str = "age") -> DataFrame:
    """Rows above the limit; a missing value is not above it."""
    return people.filter(F.col(column) > age)
