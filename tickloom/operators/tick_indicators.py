"""Indicators and signals over ticks: series of any length, a hot ticker included.

The same figures as over bars, row by row of the ticks. Tickers are cut into blocks with a
halo (:mod:`tickloom.operators.series`), and long means are differences of prefix sums
(:mod:`tickloom.operators.means`), so neither the ticks of a ticker nor the length of a
window decide what a task has to do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec

from tickloom.operators.means import prefix_macd, prefix_moving_averages, prefix_rsi
from tickloom.operators.series import BLOCK_ROWS, over_blocks
from tickloom.operators.signals import detect_crossovers, price_patterns, trading_signals
from tickloom.params import IndicatorParams

DEFAULT = IndicatorParams()
KEY = ("ticker",)


def tick_reach(params: IndicatorParams = DEFAULT) -> int:
    """How many ticks before its own the analysis of a tick looks at: the longest chain of
    windows. Crossovers look at the row before, whose averages look back as far again."""
    averages = max(params.ma_windows)
    return max(averages, params.rsi_period + 1, params.macd_slow + params.macd_signal, 10)


def tick_indicators(
    ticks: DataFrame,
    order_by: Sequence[str] = ("timestamp",),
    params: IndicatorParams = DEFAULT,
    scale: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Moving averages, RSI and MACD of each tick; ``order_by`` orders a ticker's ticks."""

    def compute(rows: DataFrame, series: WindowSpec) -> DataFrame:
        return _indicators(rows, series, params, scale)

    return over_blocks(ticks, KEY, order_by, tick_reach(params), compute, block_rows)


def _indicators(rows: DataFrame, series: WindowSpec, params: IndicatorParams, scale: int) -> DataFrame:
    return (
        rows.transform(prefix_moving_averages, params.ma_windows, series, scale)
        .transform(prefix_rsi, params.rsi_period, series, scale)
        .transform(prefix_macd, params.macd_fast, params.macd_slow, params.macd_signal, series, scale)
    )


def analysed_ticks(
    ticks: DataFrame,
    order_by: Sequence[str] = ("timestamp",),
    params: IndicatorParams = DEFAULT,
    scale: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Ticks with indicators, crossovers, ten-row range, trend and signals, as
    :func:`tickloom.operators.summary.analysed_bars` has them for bars."""

    def compute(rows: DataFrame, series: WindowSpec) -> DataFrame:
        return (
            _indicators(rows, series, params, scale)
            .transform(detect_crossovers, params, series)
            .transform(price_patterns, series)
            .transform(trading_signals)
        )

    return over_blocks(ticks, KEY, order_by, tick_reach(params), compute, block_rows)
