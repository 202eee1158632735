"""Market job: ticks to a summary per ticker."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tickloom.functions import require_rows
from tickloom.operators.bars import daily_bars
from tickloom.operators.ranges import only_tickers, padded_range
from tickloom.operators.summary import analysed_bars, summarise_by_ticker
from tickloom.params import IndicatorParams
from tickloom.sinks.files import save, write_parquet
from tickloom.sources.dispatch import open_ticks
from tickloom.workspace import settle


def market_summary(
    ticks: DataFrame,
    params: IndicatorParams = IndicatorParams(),
    order_by: Sequence[str] = ("timestamp",),
    unique_order: bool = False,
) -> DataFrame:
    """Daily bars, indicators, signals, and the latest state of each ticker."""
    bars = daily_bars(ticks, order_by=order_by, unique_order=unique_order)
    return summarise_by_ticker(analysed_bars(bars, params), params)


def market_job(
    spark: SparkSession,
    source: str,
    output: str,
    start: date | str,
    end: date | str,
    tickers: Sequence[str] | str | None = None,
    fmt: str = "json",
    save_raw: bool = False,
    params: IndicatorParams = IndicatorParams(),
    order_by: Sequence[str] = ("timestamp",),
    unique_order: bool = False,
    **source_options,
) -> DataFrame:
    """Read, analyse and save. The range is padded on both sides before it is applied.

    ``order_by`` and ``unique_order`` say how ticks are ordered within a day, see
    :func:`tickloom.operators.bars.daily_ohlcv`; for a topic, ``keep=("offset",)`` carries
    the offset along. With ``save_raw`` the ticks are written first and the analysis reads
    what was written, so both are of the same ticks even if the source grows meanwhile.
    The summary is worked out once; the returned frame reads it.

    Raises :class:`tickloom.functions.EmptyInputError` if no tick is left to analyse.
    """
    first, last = padded_range(start, end)
    ticks = open_ticks(spark, source, start=first, end=last, **source_options)
    ticks = only_tickers(ticks, tickers)
    what = f"{source} for the range and tickers"
    if save_raw:
        raw = f"{output}_raw"
        write_parquet(ticks, raw)
        ticks = spark.read.parquet(raw)
    summary = settle(market_summary(require_rows(ticks, what), params, order_by, unique_order), "summary")
    save(summary, output, fmt, params)
    return summary
