"""Indicators over the bars of each ticker, ordered by date.

Every function uses the same window, so a chain of them shuffles and sorts once. Feed
daily bars: a ticker then holds one row per trading day, whatever its tick volume. Series of
any length, such as ticks, go through :mod:`tickloom.operators.tick_indicators`, which give
the window of a part of them as ``series``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import ratio
from tickloom.params import IndicatorParams


def ticker_days() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("date")


def trailing(rows: int, series: WindowSpec | None = None) -> WindowSpec:
    """The current row and the ``rows - 1`` before it, fewer at the start."""
    return (series or ticker_days()).rowsBetween(1 - rows, Window.currentRow)


def trailing_mean(column: str, rows: int, series: WindowSpec | None = None) -> Column:
    return F.avg(column).over(trailing(rows, series))


def previous(column: str, series: WindowSpec | None = None) -> Column:
    return F.lag(column, 1).over(series or ticker_days())


def by_ticker(bars: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bring the bars of each ticker together, ahead of the functions below.

    They need this shuffle anyway. Done here it keeps its number of partitions, whereas
    Spark would merge them by size, down to one task, although long windows compute far
    more than the few bytes of the bars suggest.
    """
    if partitions is None:
        partitions = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bars.repartition(partitions, "ticker")


def moving_averages(
    bars: DataFrame, windows: Iterable[int] = (5, 10, 20, 50, 200)
) -> DataFrame:
    """``ma_<n>``: mean close of the last n rows."""
    return bars.withColumns({f"ma_{n}": trailing_mean("close", n) for n in windows})


def price_change(bars: DataFrame, series: WindowSpec | None = None) -> DataFrame:
    """``prev_close`` and the change against it; NULL on the first row."""
    return bars.withColumn("prev_close", previous("close", series)).withColumn(
        "price_change", F.col("close") - F.col("prev_close")
    )


def moves(bars: DataFrame, series: WindowSpec | None = None) -> DataFrame:
    """The change of the close with its ``gain`` and ``loss``, 0 where there is none."""
    change = F.col("price_change")
    return price_change(bars, series).withColumns(
        {
            "gain": F.when(change > 0, change).otherwise(F.lit(0.0)),
            "loss": F.when(change < 0, F.abs(change)).otherwise(F.lit(0.0)),
        }
    )


def strength(means: DataFrame) -> DataFrame:
    """``rs`` and ``rsi`` from the mean gain and loss."""
    value = ratio("avg_gain", "avg_loss")
    return means.withColumns({"rs": value, "rsi": 100 - ratio(F.lit(100.0), 1 + value)})


def rsi(bars: DataFrame, period: int = 14) -> DataFrame:
    """Relative strength index on plain means.

    A frame without a losing day has no relative strength: ``rs`` and ``rsi`` are NULL.
    """
    means = moves(bars).withColumns(
        {
            "avg_gain": trailing_mean("gain", period),
            "avg_loss": trailing_mean("loss", period),
        }
    )
    return strength(means)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """MACD with plain means in place of exponential ones."""
    means = bars.withColumns(
        {
            "ema_fast": trailing_mean("close", fast),
            "ema_slow": trailing_mean("close", slow),
        }
    )
    return (
        means.withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
        .withColumn("macd_signal", trailing_mean("macd", signal))
        .withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    )


def price_range(bars: DataFrame, days: int = 10, series: WindowSpec | None = None) -> DataFrame:
    """Highest high and lowest low of the last ``days`` rows."""
    return bars.withColumns(
        {
            f"high_{days}d": F.max("high").over(trailing(days, series)),
            f"low_{days}d": F.min("low").over(trailing(days, series)),
        }
    )


def indicators(bars: DataFrame, params: IndicatorParams = IndicatorParams()) -> DataFrame:
    """Moving averages, RSI and MACD."""
    return (
        bars.transform(moving_averages, params.ma_windows)
        .transform(rsi, params.rsi_period)
        .transform(macd, params.macd_fast, params.macd_slow, params.macd_signal)
    )
