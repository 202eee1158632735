"""Ridership over a range of days from stored figures per day.

The figures of the report are sums, so those of several days follow from those of each.
They are stored once a day, by line and station, some hundred rows however many rows landed;
a report over any range reads these and none of the landed rows. A day that is landed again
replaces its figures and no others.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ridership import report_lines, usage_by_line_and_station
from tickloom.plans.ridership import read_ridership
from tickloom.sinks.reports import write_usage_report
from tickloom.sources.paths import daily_paths
from tickloom.workspace import settle

DAY = "day"
USAGE = "day date, line_name string, station_name string, total bigint, boarding bigint, alighting bigint"


def _folder(root: str) -> str:
    return f"{root}/usage"


def usage_by_day(rows: DataFrame, day: str = DAY) -> DataFrame:
    """The figures of each day by line and station, in one pass over rows of any days."""
    keyed = rows.groupBy(F.col(day).cast("date").alias(DAY), F.col("SBWY_ROUT_LN_NM").alias("line_name"), F.col("SBWY_STNS_NM").alias("station_name"))
    return keyed.agg(
        F.sum(F.col("GTON_TNOPE") + F.col("GTOFF_TNOPE")).alias("total"),
        F.sum("GTON_TNOPE").alias("boarding"),
        F.sum("GTOFF_TNOPE").alias("alighting"),
    )


def store_usage(usage: DataFrame, root: str) -> None:
    """Store figures of days, one file a day; each day there replaces what it had before,
    all other days stay as they are."""
    writer = usage.repartition(DAY).write.partitionBy(DAY).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(_folder(root))


def store_day(spark: SparkSession, run_date: date | str, root: str, lag_days: int = 7) -> None:
    """Store the figures of the rows landed for the day of a run."""
    paths = daily_paths(run_date, root, lag_days)
    usage = usage_by_line_and_station(read_ridership(spark, paths.landing))
    store_usage(usage.withColumn(DAY, F.lit(paths.day)), root)


def stored_usage(
    spark: SparkSession, root: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Figures by day, line and station of an inclusive range of days; the folders of other
    days are not read."""
    rows = spark.read.schema(USAGE).parquet(_folder(root))
    if start is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(str(start)[:10]).cast("date"))
    if end is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(str(end)[:10]).cast("date"))
    return rows


def merged_usage(usage: DataFrame) -> DataFrame:
    """Figures of several days as those of one, for :func:`report_lines`. Unknown figures
    stay unknown where no day knows them."""
    return usage.groupBy("line_name", "station_name").agg(*(F.sum(x).alias(x) for x in ("total", "boarding", "alighting")))


def range_lines(
    spark: SparkSession, root: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """All sections of the report over a range of days."""
    return report_lines(settle(merged_usage(stored_usage(spark, root, start, end)), "usage"))


def report_range(
    spark: SparkSession, root: str, start: date | str, end: date | str, generated_at: datetime | None = None
) -> str:
    """Report on a range of days from the stored figures; returns where the report is."""
    path = f"{root}/analysis/{str(start)[:10].replace('-', '')}-{str(end)[:10].replace('-', '')}.json"
    write_usage_report(merged_usage(stored_usage(spark, root, start, end)), path, generated_at)
    return path


def missing_days(spark: SparkSession, root: str, days: Iterable[date]) -> list[date]:
    """Those of some days that have no figures yet; only names of folders are looked at."""
    there = {row[DAY] for row in stored_usage(spark, root).select(DAY).distinct().collect()}
    return [day for day in days if day not in there]
