"""Parameters of the market indicators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class IndicatorParams:
    """Periods (in rows, i.e. trading days) and thresholds of the indicators."""

    ma_short: int = 5
    ma_long: int = 20
    rsi_period: int = 14
    rsi_overbought: float = 70.0
    rsi_oversold: float = 30.0
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9

    # The trend and the summary always look at these two averages.
    trend_windows = (50, 200)

    @property
    def ma_windows(self) -> tuple[int, ...]:
        """Moving-average periods, each once even if short/long repeat 50 or 200."""
        return tuple(dict.fromkeys((self.ma_short, self.ma_long, *self.trend_windows)))

    @property
    def short_column(self) -> str:
        return f"ma_{self.ma_short}"

    @property
    def long_column(self) -> str:
        return f"ma_{self.ma_long}"
