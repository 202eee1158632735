"""Row selection by date, time and ticker."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.workspace import settle


def _between(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    # Bounds take the type of the column, so that the comparison reaches the scan.
    kind = df.schema[column].dataType
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast(kind))
    return df


def _date_text(bound: date | str | None) -> str | None:
    if bound is None:
        return None
    moment = datetime.fromisoformat(bound) if isinstance(bound, str) else bound
    return f"{moment:%Y-%m-%d}"


def _time_text(bound: datetime | str | None) -> str | None:
    if bound is None or isinstance(bound, str):
        return bound
    return bound.isoformat(sep=" ")


def between_dates(
    df: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    column: str = "date",
) -> DataFrame:
    """Inclusive date range; either bound may be missing."""
    return _between(df, column, _date_text(start), _date_text(end))


def between_times(
    df: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    column: str = "timestamp",
) -> DataFrame:
    """Inclusive time range; either bound may be missing."""
    return _between(df, column, _time_text(start), _time_text(end))


def padded_range(
    start: date | str, end: date | str, before: int = 3, after: int = 1
) -> tuple[datetime, datetime]:
    """Midnights ``before`` days ahead of the start and ``after`` days past the end."""
    first = datetime.fromisoformat(_date_text(start))
    last = datetime.fromisoformat(_date_text(end))
    return first - timedelta(days=before), last + timedelta(days=after)


def only_tickers(df: DataFrame, tickers: Sequence[str] | str | None) -> DataFrame:
    """Rows of the given tickers, a list or comma-separated text; no list keeps all."""
    if not tickers:
        return df
    if isinstance(tickers, str):
        tickers = tickers.split(",")
    return df.filter(F.col("ticker").isin(list(tickers)))


def listed_tickers(df: DataFrame, tickers: DataFrame, column: str = "ticker") -> DataFrame:
    """Rows of the tickers listed in the table ``tickers``, of any length, each row once.

    A semi join with the list written once, whose size Spark then knows: it broadcasts a
    short list and shuffles a long one. Where ``df`` is stored in a folder per ticker
    (:func:`tickloom.sinks.ticks.write_by_ticker`), a short list also prunes the scan while
    the query runs: folders of other tickers are not read.
    """
    listed = settle(tickers.select(F.col(column).alias("_wanted")).distinct(), "listed")
    # The condition tells Spark that the list selects, without which it never prunes.
    wanted = listed.filter(F.length("_wanted") > 0)
    return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
