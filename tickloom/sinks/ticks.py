"""Stored ticks, laid out for the questions that are asked of them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ranges import between_dates

BUCKETS = 16
MONTH = "month"


def write_by_ticker(ticks: DataFrame, path: str, column: str = "ticker") -> None:
    """A folder for each ticker. The ticks of a task are sorted by ticker first, so a task
    holds one file open at a time; a hot ticker is written by all tasks that have it."""
    ticks.write.mode("overwrite").partitionBy(column).parquet(path)


def write_tick_table(
    ticks: DataFrame, table: str, path: str, buckets: int = BUCKETS, key: str = "ticker", day: str = "date"
) -> None:
    """A table with a folder for each month and, in it, ticks bucketed by ticker and sorted
    by day within a bucket.

    A range of days reads only the folders of its months and, in those, only the groups of
    rows with such days. Whatever works by ticker needs no exchange: the buckets have done
    that once and for all. The number of buckets bounds the tasks of such a query, and a hot
    ticker lies in one bucket; combine ticks to bars first.
    """
    month = F.date_format(day, "yyyyMM")
    # One task for each file, rather than each task a file in every folder.
    placed = ticks.withColumn(MONTH, month).repartition(MONTH, F.pmod(F.hash(key), F.lit(buckets)))
    writer = placed.write.mode("overwrite").partitionBy(MONTH).bucketBy(buckets, key).sortBy(key, day)
    writer.option("path", path).saveAsTable(table)


def read_tick_table(
    spark: SparkSession, table: str, start: date | str | None = None, end: date | str | None = None, day: str = "date"
) -> DataFrame:
    """Ticks of an inclusive range of days; months outside of it are not listed or read."""
    rows = between_dates(spark.table(table), start, end, day)
    for bound, within in ((start, F.col(MONTH).__ge__), (end, F.col(MONTH).__le__)):
        if bound is not None:
            rows = rows.filter(within(F.date_format(F.lit(str(bound)[:10]).cast("date"), "yyyyMM")))
    return rows.drop(MONTH)
