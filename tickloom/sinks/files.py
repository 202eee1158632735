"""File sinks. All of them replace what was there and raise when they fail."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tickloom.params import IndicatorParams
from tickloom.sinks.reports import write_ticker_documents


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file, written by one task: for results of known small size.

    The rows are computed by all tasks and only then brought together.
    """
    write_csv(df.repartition(1), path)


def land_json(rows: DataFrame, path: str) -> None:
    """JSON lines, one object per row; texts are kept as they are."""
    rows.write.mode("overwrite").json(path)


def default_output(day: date | None = None) -> str:
    return f"stock_analysis_results_{day or date.today():%Y%m%d}"


def save(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    params: IndicatorParams = IndicatorParams(),
) -> str:
    """Save a ticker summary as ``parquet``, ``csv``, or ``json`` documents; return where."""
    kind = fmt.lower()
    path = path or default_output()
    if kind == "parquet":
        write_parquet(df, path)
    elif kind == "csv":
        write_csv(df, path)
    elif kind == "json":
        write_ticker_documents(df, path, params)
    else:
        raise ValueError(f"unknown format {fmt!r}; use parquet, csv or json")
    return path


def save_with_raw(
    result: DataFrame,
    raw: DataFrame | None,
    path: str | None = None,
    fmt: str = "json",
    params: IndicatorParams = IndicatorParams(),
) -> None:
    """Save the result and, if given, the ticks as Parquet beside it."""
    path = save(result, path, fmt, params)
    if raw is not None:
        write_parquet(raw, f"{path}_raw")
