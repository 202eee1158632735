"""JDBC scans. Credentials always come from the caller."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_TABLE_NAME = re.compile(r"[A-Za-z_][\w$]*(\.[A-Za-z_][\w$]*){0,2}")


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a table scan or write.

    With ``partition_column`` the scan is split into ``partitions`` ranges read side by
    side; without it one task reads the whole table, which only fits small tables.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None, **split
) -> DataFrame:
    options = jdbc_options(url, table, properties, **split)
    return spark.read.format("jdbc").options(**options).load()


def read_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    conditions: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The rows that meet any of some conditions, one task and connection for each."""
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties or {})


def preview_query(table: str = "public.sample_table", rows: int = 10) -> str:
    """The first rows of a table as a derived table, so that the limit runs in the database."""
    if not _TABLE_NAME.fullmatch(table):
        raise ValueError(f"not a table name: {table!r}")
    return f"(SELECT * FROM {table} LIMIT {int(rows)}) preview"


def preview_table(
    spark: SparkSession,
    url: str,
    table: str = "public.sample_table",
    properties: dict[str, str] | None = None,
    rows: int = 10,
) -> DataFrame:
    return read_table(spark, url, preview_query(table, rows), properties)
