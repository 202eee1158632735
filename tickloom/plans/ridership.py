"""Ridership jobs: landing the rows of a day, and reporting on them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ridership import (
    report_lines,
    usage_by_line_and_station,
    with_counters,
)
from tickloom.schemas import RIDERSHIP_ROW
from tickloom.sinks.files import land_json
from tickloom.sinks.reports import write_report
from tickloom.sources.envelope import envelope_rows, read_envelopes
from tickloom.sources.files import read_json_lines
from tickloom.sources.paths import daily_paths
from tickloom.workspace import settle


def land_ridership(
    spark: SparkSession,
    answers: str,
    run_date: date | str,
    root: str,
    lag_days: int = 7,
    one_per_file: bool = True,
) -> str | None:
    """Land the rows of the accepted answers as JSON lines of their day.

    Returns the location, or None if every answer reported an error.
    """
    rows = envelope_rows(read_envelopes(spark, answers, one_per_file))
    if rows.isEmpty():
        return None
    target = daily_paths(run_date, root, lag_days).landing
    land_json(rows, target)
    return target


def read_ridership(spark: SparkSession, path: str) -> DataFrame:
    return with_counters(read_json_lines(spark, path, RIDERSHIP_ROW))


def report_ridership(
    spark: SparkSession,
    run_date: date | str,
    root: str,
    lag_days: int = 7,
    generated_at: datetime | None = None,
) -> str:
    """Report on the rows landed for the day; returns the location of the report."""
    paths = daily_paths(run_date, root, lag_days)
    write_report(read_ridership(spark, paths.landing), paths.report, generated_at)
    return paths.report


def ridership_figures(rows: DataFrame) -> dict[str, DataFrame]:
    """The figures one by one, for a look at them; one pass over the rows serves all."""
    lines = report_lines(settle(usage_by_line_and_station(rows), "usage"))

    def section(name: str, order: str, **columns: str) -> DataFrame:
        own = lines.filter(F.col("section") == name)
        picked = own.select(*(F.col(source).alias(alias) for alias, source in columns.items()))
        return picked.orderBy(F.col(order).desc_nulls_last(), next(iter(columns)))

    return {
        "total_by_line": section("total_by_line", "total_passengers", line_name="name", total_passengers="total"),
        "station_stats": section(
            "station_stats", "total_boarding", station_name="name", total_boarding="boarding", total_alighting="alighting"
        ),
        "ratio_top10": section("ratio_top10", "board_to_alight_ratio", station_name="name", board_to_alight_ratio="ratio"),
        "top5_stations": section("top5_stations", "total_usage", station_name="name", total_usage="total"),
    }
