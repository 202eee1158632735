"""Documents per ticker, and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.documents import documents_as_json, ticker_documents
from tickloom.operators.ridership import (
    report_document,
    report_entries,
    report_lines,
    usage_by_line_and_station,
)
from tickloom.params import IndicatorParams
from tickloom.workspace import settle

def write_ticker_documents(
    df: DataFrame, path: str, params: IndicatorParams = IndicatorParams()
) -> None:
    """One JSON document per line and ticker, written by all tasks."""
    documents = documents_as_json(ticker_documents(df, params))
    documents.select("document").write.mode("overwrite").text(path)


def _lines_and_moment(usage: DataFrame, generated_at: datetime | None) -> tuple[DataFrame, str]:
    # One pass over the rows; every section reads its small result.
    lines = report_lines(settle(usage, "usage"))
    return lines, f"{generated_at or datetime.now():%Y-%m-%d %H:%M:%S}"


def write_report(rows: DataFrame, path: str, generated_at: datetime | None = None) -> None:
    """Write the ridership report as JSON lines in order, over any number of stations."""
    write_usage_report(usage_by_line_and_station(rows), path, generated_at)


def write_usage_report(usage: DataFrame, path: str, generated_at: datetime | None = None) -> None:
    """The same from figures by line and station."""
    entries = report_entries(*_lines_and_moment(usage, generated_at))
    entries.write.mode("overwrite").text(path)


def write_report_document(rows: DataFrame, path: str, generated_at: datetime | None = None) -> None:
    """Write the ridership report as a single JSON document, which one task puts together."""
    document = report_document(*_lines_and_moment(usage_by_line_and_station(rows), generated_at))
    document.write.mode("overwrite").text(path)
