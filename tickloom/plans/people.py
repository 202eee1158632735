"""The two CSV jobs: profile a column, and pick people by age."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickloom.operators.people import older_than, with_initial
from tickloom.operators.profile import column_profile
from tickloom.sinks.files import write_csv, write_single_csv
from tickloom.sources.files import read_csv


def profile_csv(
    spark: SparkSession,
    path: str,
    output: str,
    column: str = "age",
    schema: StructType | None = None,
) -> DataFrame:
    """Profile a column of a CSV file and save the one-row result as one file."""
    profile = column_profile(read_csv(spark, path, schema), column)
    write_single_csv(profile, output)
    return profile


def select_people(
    people: DataFrame, output: str, age: float = 26, single_file: bool = False
) -> DataFrame:
    """People above the age with their initial, saved as CSV; ``single_file`` writes one
    file with one task, for small results."""
    selected = with_initial(older_than(people, age))
    (write_single_csv if single_file else write_csv)(selected, output)
    return selected
