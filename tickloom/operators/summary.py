"""One summary row per ticker from bars with indicators and signals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions import percent_above
from tickloom.operators.indicators import by_ticker, indicators
from tickloom.operators.latest import latest_per_key
from tickloom.operators.signals import (
    detect_crossovers,
    ma_status,
    price_patterns,
    rsi_status,
    trading_signals,
)
from tickloom.params import IndicatorParams
from tickloom.schemas import DAILY_BAR_COLUMNS

DEFAULT = IndicatorParams()


def analysed_bars(bars: DataFrame, params: IndicatorParams = DEFAULT) -> DataFrame:
    """Bars with indicators, crossovers, ten-day range, trend and signals."""
    return (
        bars.transform(by_ticker)
        .transform(indicators, params)
        .transform(detect_crossovers, params)
        .transform(price_patterns)
        .transform(trading_signals)
    )


def summary_columns(params: IndicatorParams = DEFAULT) -> list[str]:
    averages = [f"ma_{n}" for n in params.ma_windows]
    oscillators = ["rsi", "macd", "macd_signal", "macd_histogram"]
    labels = ["trend", "buy_signal", "sell_signal", "signal_strength"]
    return [*DAILY_BAR_COLUMNS, *averages, *oscillators, *labels]


def summarise_by_ticker(analysed: DataFrame, params: IndicatorParams = DEFAULT) -> DataFrame:
    """The latest row of each ticker with the long-term spread and two states."""
    return (
        latest_per_key(analysed)
        .select(*summary_columns(params))
        .withColumn("ma_50_200_diff_pct", percent_above("ma_50", "ma_200"))
        .transform(rsi_status, params)
        .transform(ma_status, params)
    )
