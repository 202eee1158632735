"""Crossovers, trend, trading signals and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import flag
from tickloom.operators.indicators import previous, price_range
from tickloom.params import IndicatorParams

DEFAULT = IndicatorParams()


def _crosses(upper: str, lower: str, above: str, below: str) -> dict[str, Column]:
    """Flags for ``upper`` rising over and falling under ``lower`` since the last row."""
    was_upper, was_lower = F.col(f"prev_{upper}"), F.col(f"prev_{lower}")
    is_upper, is_lower = F.col(upper), F.col(lower)
    return {
        above: flag((is_upper > is_lower) & (was_upper <= was_lower)),
        below: flag((is_upper < is_lower) & (was_upper >= was_lower)),
    }


def _with_previous(df: DataFrame, series: WindowSpec | None, *columns: str) -> DataFrame:
    return df.withColumns({f"prev_{name}": previous(name, series) for name in columns})


def ma_crossovers(
    df: DataFrame, params: IndicatorParams = DEFAULT, series: WindowSpec | None = None
) -> DataFrame:
    """``golden_cross`` and ``death_cross`` of the short and long average."""
    short, long = params.short_column, params.long_column
    return _with_previous(df, series, short, long).withColumns(
        _crosses(short, long, "golden_cross", "death_cross")
    )


def macd_crossovers(df: DataFrame, series: WindowSpec | None = None) -> DataFrame:
    """``macd_bullish_cross`` and ``macd_bearish_cross`` of MACD and its signal."""
    return _with_previous(df, series, "macd", "macd_signal").withColumns(
        _crosses("macd", "macd_signal", "macd_bullish_cross", "macd_bearish_cross")
    )


def rsi_flags(df: DataFrame, params: IndicatorParams = DEFAULT) -> DataFrame:
    """``rsi_overbought`` and ``rsi_oversold``; 0 while the RSI is unknown."""
    return df.withColumns(
        {
            "rsi_overbought": flag(F.col("rsi") > params.rsi_overbought),
            "rsi_oversold": flag(F.col("rsi") < params.rsi_oversold),
        }
    )


def detect_crossovers(
    df: DataFrame, params: IndicatorParams = DEFAULT, series: WindowSpec | None = None
) -> DataFrame:
    return (
        df.transform(ma_crossovers, params, series)
        .transform(rsi_flags, params)
        .transform(macd_crossovers, series)
    )


def _direction(price: str, near: str, far: str) -> Column:
    """Whether price, near and far average fall or rise in that order."""
    p, n, f = F.col(price), F.col(near), F.col(far)
    return (
        F.when((p > n) & (n > f), "bullish")
        .when((p < n) & (n < f), "bearish")
        .otherwise("neutral")
    )


def trend(df: DataFrame) -> DataFrame:
    return df.withColumn("trend", _direction("close", "ma_50", "ma_200"))


def price_patterns(df: DataFrame, series: WindowSpec | None = None) -> DataFrame:
    """Ten-day range and trend."""
    return df.transform(price_range, 10, series).transform(trend)


def _first_set(*signals: tuple[str, str]) -> Column:
    """Name of the first flag that is set, else NULL."""
    return F.coalesce(*(F.when(F.col(name) == 1, label) for name, label in signals))


def trading_signals(df: DataFrame) -> DataFrame:
    """``buy_signal``, ``sell_signal`` and ``signal_strength``."""
    ma_cross = (F.col("golden_cross") == 1) | (F.col("death_cross") == 1)
    rsi_extreme = (F.col("rsi_oversold") == 1) | (F.col("rsi_overbought") == 1)
    macd_cross = (F.col("macd_bullish_cross") == 1) | (F.col("macd_bearish_cross") == 1)
    return df.withColumns(
        {
            "buy_signal": _first_set(
                ("golden_cross", "golden_cross"),
                ("rsi_oversold", "rsi_oversold"),
                ("macd_bullish_cross", "macd_bullish"),
            ),
            "sell_signal": _first_set(
                ("death_cross", "death_cross"),
                ("rsi_overbought", "rsi_overbought"),
                ("macd_bearish_cross", "macd_bearish"),
            ),
            "signal_strength": F.when(ma_cross & rsi_extreme, "strong")
            .when(ma_cross | rsi_extreme, "medium")
            .when(macd_cross, "weak"),
        }
    )


def rsi_status(df: DataFrame, params: IndicatorParams = DEFAULT) -> DataFrame:
    """State of the RSI. An RSI of exactly 0 counts as unknown."""
    value = F.col("rsi")
    return df.withColumn(
        "rsi_status",
        F.when(value.isNull() | (value == 0), "unknown")
        .when(value > params.rsi_overbought, "overbought")
        .when(value < params.rsi_oversold, "oversold")
        .otherwise("neutral"),
    )


def ma_status(df: DataFrame, params: IndicatorParams = DEFAULT) -> DataFrame:
    return df.withColumn(
        "ma_status", _direction("close", params.short_column, params.long_column)
    )
