"""Ticks to daily bars."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import DAILY_BAR_COLUMNS


@dataclass(frozen=True)
class StockFrames:
    """Ticks and, if any, the daily bars made from them."""

    raw: DataFrame
    daily: DataFrame | None = None

    def at(self, frequency: str = "daily") -> DataFrame:
        """The daily bars; the ticks if asked for or if there are no bars."""
        if frequency == "raw" or self.daily is None:
            return self.raw
        return self.daily


def daily_ohlcv(
    ticks: DataFrame,
    order_by: Sequence[str] = ("timestamp",),
    unique_order: bool = False,
) -> DataFrame:
    """One bar per ticker and day.

    Open and close are the prices of the first and last tick by ``order_by``; among
    ticks with the same order the lowest open and the highest close count, so the
    result does not depend on how the ticks are spread over tasks. Ticks are combined
    before the shuffle: a task sends one row per ticker and day, however hot the ticker.

    ``unique_order`` promises that a single order column, such as an offset or a precise
    time, never repeats within a ticker and day. Then the state is of fixed width and
    tasks hash their ticks instead of sorting them, two to three times as fast.
    :func:`tickloom.functions.wide_key` makes one such column of two.
    """
    if unique_order:
        (order,) = order_by
        first_open = F.min_by("open", order)
        last_close = F.max_by("close", order)
    else:
        first_open = F.min(F.struct(*order_by, "open"))["open"]
        last_close = F.max(F.struct(*order_by, "close"))["close"]
    # Date first: where the aggregation sorts, a date compares faster than a text.
    bars = ticks.groupBy("date", "ticker").agg(
        first_open.alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        last_close.alias("close"),
        F.sum("volume").alias("volume"),
        F.count("*").alias("data_points"),
    )
    return bars.select(*DAILY_BAR_COLUMNS, "data_points")


def daily_bars(ticks: DataFrame, **order) -> DataFrame:
    """The bar columns in their fixed order."""
    return daily_ohlcv(ticks, **order).select(*DAILY_BAR_COLUMNS)


def stock_frames(ticks: DataFrame, **order) -> StockFrames:
    """Ticks with their daily bars; bars exist exactly if there is a tick."""
    if ticks.isEmpty():
        return StockFrames(raw=ticks)
    return StockFrames(raw=ticks, daily=daily_bars(ticks, **order))
