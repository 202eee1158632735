"""Blocks with a halo and prefix sums equal the plain windows."""

import random

import pytest
from helpers import bars_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind
from tickloom.operators import means, series
from tickloom.operators.summary import analysed_bars
from tickloom.operators.tick_indicators import analysed_ticks, tick_indicators, tick_reach
from tickloom.params import IndicatorParams

SMALL = IndicatorParams(ma_short=3, ma_long=7, rsi_period=5, macd_fast=3, macd_slow=6, macd_signal=4)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def hot(spark):
    """4,000 rows, a third of one ticker, some of none, several tickers of one row."""
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        ticker = "HOT" if i % 3 == 0 else None if i % 40 == 1 else f"T{rng.randint(0, 25)}"
        rows.append((ticker, i, float(rng.randint(1, 900)) if i % 17 else None))
    rows += [(f"ONE{i}", i, 5.0) for i in range(20)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "ticker string, n int, close double").repartition(7).cache()


@pytest.mark.parametrize("reach, block", [(0, 100), (9, 100), (60, 50), (9, 10)])
def test_blocks_equal_the_plain_window(hot, reach, block):
    frame = Window.partitionBy("ticker").orderBy("n").rowsBetween(-reach, 0)
    plain = hot.withColumn("total", F.sum("close").over(frame)).withColumn("rows", F.count(F.lit(1)).over(frame))

    def compute(rows, part):
        own = part.rowsBetween(-reach, 0)
        return rows.withColumn("total", F.sum("close").over(own)).withColumn("rows", F.count(F.lit(1)).over(own))

    found = series.over_blocks(hot, ["ticker"], ["n"], reach, compute, block)
    assert rows_of(found) == rows_of(plain)


def test_no_group_is_larger_than_a_block_and_its_halo(hot):
    ordered = series.in_order(hot, ["ticker"], ["n"], ranges=5)
    numbered = series.in_blocks(ordered, ["ticker"], 64)
    groups = series.with_halo(numbered, 20, 64).groupBy("ticker", series.BLOCK).count().collect()
    assert max(r["count"] for r in groups) <= 84
    assert len([r for r in groups if r.ticker == "HOT"]) >= 1333 // 64
    # No block of rows is left out, and none has the place of another.
    places = numbered.filter("ticker = 'HOT'").select("_number").distinct().count()
    assert places == hot.filter("ticker = 'HOT'").count()


def test_empty_and_null_series(spark, hot):
    compute = lambda rows, part: rows.withColumn("before", F.lag("close").over(part))
    assert series.over_blocks(hot.limit(0), ["ticker"], ["n"], 1, compute).collect() == []
    nobody = hot.filter("ticker IS NULL")
    found = series.over_blocks(nobody, ["ticker"], ["n"], 1, compute, 10)
    assert rows_of(found) == rows_of(nobody.withColumn("before", F.lag("close").over(Window.partitionBy("ticker").orderBy("n"))))


def test_prefix_means_equal_plain_means(spark):
    rng = random.Random(2)
    bars = bars_of(spark, A=[rng.randint(1, 10**6) for _ in range(300)], B=[4, 4, 9], C=[1])
    for n in (1, 7, 200, 2000):
        assert rows_of(means.prefix_moving_averages(bars, [n])) == rows_of(ind.moving_averages(bars, [n]))
    assert rows_of(means.prefix_rsi(bars)) == rows_of(ind.rsi(bars))
    assert rows_of(means.prefix_macd(bars)) == rows_of(ind.macd(bars))


def test_prefix_means_skip_nulls_and_refuse_parts_of_cents(spark):
    bars = bars_of(spark, A=[1, 2, 3, 4]).withColumn("close", F.when(F.col("close") != 3, F.col("close")))
    expected = rows_of(ind.moving_averages(bars, [2]))
    assert rows_of(means.prefix_moving_averages(bars, [2])) == expected
    cents = bars.withColumn("close", F.col("close") / 100)
    found = means.prefix_moving_averages(cents, [2], scale=100).select("ma_2").collect()
    assert [r.ma_2 for r in found] == [0.01, 0.015, 0.02, 0.04]
    with pytest.raises(Exception, match="no whole number"):
        means.prefix_moving_averages(cents, [2]).collect()


def test_ticks_of_a_hot_ticker_are_analysed_like_bars(spark):
    rng = random.Random(8)
    bars = bars_of(spark, HOT=[rng.randint(100, 999) for _ in range(700)], A=[rng.randint(1, 99) for _ in range(90)], B=[3])
    assert rows_of(analysed_ticks(bars, ["date"], SMALL, block_rows=210)) == rows_of(analysed_bars(bars, SMALL))
    default = IndicatorParams()
    assert tick_reach(default) == 200
    assert rows_of(tick_indicators(bars, ["date"], default, block_rows=250)) == rows_of(ind.indicators(bars, default))
