"""Trailing means from prefix sums: one addition a row, however long the window.

Spark adds up every frame of a moving window anew, 2,000 additions a row for a mean of
2,000. Here a running sum is taken once and each mean is the difference of two of its
values, as the sums are of whole numbers and so exact: a mean has the bits the plain one
has, as long as the sum of a window stays below 2**53.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import ratio
from tickloom.operators.indicators import moves, strength, ticker_days, trailing_mean


def prefix_means(
    df: DataFrame, means: Mapping[str, tuple[str, int]], series: WindowSpec | None = None, scale: int = 1
) -> DataFrame:
    """Add trailing means: name → (column, rows). NULLs count for nothing.

    Values times ``scale`` must be whole numbers: prices in whole cents as they are, or in
    money with ``scale=100``. A value that is not makes the query fail rather than differ.
    """
    series = series or ticker_days()
    upto = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = list(dict.fromkeys(column for column, _ in means.values()))
    sums = {}
    for i, column in enumerate(columns):
        scaled = F.col(column) * scale
        near = F.abs(scaled - F.rint(scaled)) <= 1e-9 * F.abs(scaled) + (1e-6 if scale > 1 else 0.0)
        refused = F.raise_error(F.lit(f"{column} is no whole number at scale {scale}")).cast("bigint")
        whole = F.when(scaled.isNull(), F.lit(0).cast("bigint")).when(near, F.rint(scaled).cast("bigint")).otherwise(refused)
        sums[f"_sum_{i}"] = F.sum(whole).over(upto)
        sums[f"_count_{i}"] = F.count(column).over(upto)
    summed = df.withColumns(sums)
    made = {}
    for name, (column, rows) in means.items():
        i = columns.index(column)
        parts = [F.col(x) - F.lag(x, rows, 0).over(series) for x in (f"_sum_{i}", f"_count_{i}")]
        made[name] = ratio(parts[0].cast("double"), (parts[1] * scale).cast("double"))
    return summed.withColumns(made).drop(*sums)


def prefix_moving_averages(
    df: DataFrame, windows=(5, 10, 20, 50, 200), series: WindowSpec | None = None, scale: int = 1
) -> DataFrame:
    """``ma_<n>`` as :func:`tickloom.operators.indicators.moving_averages` has them."""
    return prefix_means(df, {f"ma_{n}": ("close", n) for n in windows}, series, scale)


def prefix_rsi(df: DataFrame, period: int = 14, series: WindowSpec | None = None, scale: int = 1) -> DataFrame:
    """As :func:`tickloom.operators.indicators.rsi`: gains and losses are whole as well."""
    named = {"avg_gain": ("gain", period), "avg_loss": ("loss", period)}
    return strength(prefix_means(moves(df, series), named, series, scale))


def prefix_macd(
    df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, series: WindowSpec | None = None, scale: int = 1
) -> DataFrame:
    """As :func:`tickloom.operators.indicators.macd`. The difference of two means is no
    whole number, so the signal, a short mean, is added up frame by frame."""
    means = prefix_means(df, {"ema_fast": ("close", fast), "ema_slow": ("close", slow)}, series, scale)
    return (
        means.withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
        .withColumn("macd_signal", trailing_mean("macd", signal, series))
        .withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    )
