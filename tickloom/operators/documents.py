"""Nested documents per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import day_text, zero_if_missing
from tickloom.operators.indicators import previous
from tickloom.params import IndicatorParams

# Texts of the signal descriptions.
BUY_DESCRIPTION = "%s 매수 신호 감지"
SELL_DESCRIPTION = "%s 매도 신호 감지"


def _signal(column: str, direction: str, description: str) -> Column:
    name = F.col(column)
    return F.when(
        F.length(name) > 0,
        F.struct(
            name.alias("type"),
            F.lit(direction).alias("direction"),
            F.col("signal_strength").alias("strength"),
            F.format_string(description, name).alias("description"),
        ),
    )


def ticker_documents(df: DataFrame, params: IndicatorParams = IndicatorParams()) -> DataFrame:
    """The last row of each ticker as a document; missing numbers become 0.

    ``change_pct`` is set where the frame holds an earlier row of that ticker with a
    positive close.
    """
    numbers = ["open", "high", "low", "close"]
    averages = {"ma_short": params.short_column, "ma_long": params.long_column}
    measures = ["ma_50", "ma_200", "rsi", "macd", "macd_signal", "macd_histogram"]
    newest_first = Window.partitionBy("ticker").orderBy(F.desc("date"))
    before, close = F.col("_before"), zero_if_missing("close")
    last_rows = (
        df.withColumn("_before", previous("close"))
        .withColumn("_position", F.row_number().over(newest_first))
        .filter(F.col("_position") == 1)
    )
    return last_rows.select(
        "ticker",
        day_text("date").alias("date"),
        *(zero_if_missing(name).alias(name) for name in numbers),
        F.coalesce(F.col("volume").cast("long"), F.lit(0)).alias("volume"),
        *(zero_if_missing(source).alias(name) for name, source in averages.items()),
        *(zero_if_missing(name).alias(name) for name in measures),
        "trend",
        "ma_status",
        "rsi_status",
        F.array_compact(
            F.array(
                _signal("buy_signal", "buy", BUY_DESCRIPTION),
                _signal("sell_signal", "sell", SELL_DESCRIPTION),
            )
        ).alias("signals"),
        F.when(before > 0, (close - before) / before * 100).alias("change_pct"),
    )


def documents_as_json(documents: DataFrame) -> DataFrame:
    """``ticker`` and ``document``, the document as JSON text.

    Missing texts are written as null; ``change_pct`` is left out where it is unknown.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    always = [name for name in documents.columns if name != "change_pct"]
    return documents.select(
        "ticker",
        F.when(F.col("change_pct").isNull(), F.to_json(F.struct(*always), keep_nulls))
        .otherwise(F.to_json(F.struct(*always, "change_pct"), keep_nulls))
        .alias("document"),
    )
