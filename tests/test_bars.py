import random
from datetime import date, datetime

import pytest
from helpers import BAR_SCHEMA, TICK_SCHEMA, bars_of, day, tick
from pyspark.sql import functions as F

from tickloom.operators.bars import StockFrames, daily_bars, daily_ohlcv, stock_frames
from tickloom.operators.latest import latest_by_join, latest_per_key, newest_per_key
from tickloom.operators.ranges import (
    between_dates,
    between_times,
    only_tickers,
    padded_range,
)
from tickloom.schemas import TICK
from tickloom.workspace import settle


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ticks_of_one_day():
    return [
        tick("A", "2024-01-02 15:30:00", 12.0, 5),
        tick("A", "2024-01-02 09:00:00", 10.0, 7),
        tick("A", "2024-01-02 11:00:00", 20.0, 1),
        tick("A", "2024-01-03 09:00:00", 13.0, 2),
        tick("B", "2024-01-02 09:00:00", 1.0, 3_000_000_000),
    ]


@pytest.mark.parametrize("unique", [False, True])
def test_open_and_close_follow_time_not_arrival(spark, unique):
    bars = daily_bars(spark.createDataFrame(ticks_of_one_day(), TICK_SCHEMA), unique_order=unique)
    assert rows(bars) == [
        ("A", date(2024, 1, 2), 10.0, 20.5, 9.5, 12.0, 13),
        ("A", date(2024, 1, 3), 13.0, 13.5, 12.5, 13.0, 2),
        ("B", date(2024, 1, 2), 1.0, 1.5, 0.5, 1.0, 3_000_000_000),
    ]


def test_equal_times_do_not_depend_on_partitions(spark):
    generator = random.Random(7)
    ticks = [tick("A", "2024-01-02 09:00:00", float(p)) for p in range(200)]
    generator.shuffle(ticks)
    frame = spark.createDataFrame(ticks, TICK_SCHEMA)
    results = {tuple(rows(daily_bars(frame.repartition(n)))) for n in (1, 3, 7)}
    assert len(results) == 1
    ((bar,),) = results
    assert (bar[2], bar[5]) == (0.0, 199.0)


def test_first_tick_without_price_gives_no_open(spark):
    ticks = [
        ("A", datetime(2024, 1, 2, 9), day(2), None, 2.0, 1.0, 1.5, 1),
        ("A", datetime(2024, 1, 2, 10), day(2), 1.0, 3.0, 1.0, 2.5, None),
    ]
    (bar,) = daily_ohlcv(spark.createDataFrame(ticks, TICK_SCHEMA)).collect()
    assert (bar.open, bar.close, bar.volume, bar.data_points) == (None, 2.5, 1, 2)


def test_bars_stay_within_their_range(spark):
    generator = random.Random(1)
    ticks = [
        tick(generator.choice("AB"), f"2024-01-0{generator.randint(1, 3)} 09:00:0{i % 10}", float(i))
        for i in generator.sample(range(1000), 300)
    ]
    bars = daily_bars(spark.createDataFrame(ticks, TICK_SCHEMA))
    outside = (F.least("open", "close") < F.col("low")) | (F.greatest("open", "close") > F.col("high"))
    assert bars.filter(outside).isEmpty()


def test_hot_ticker_is_combined_before_the_shuffle(spark):
    frame = spark.createDataFrame(ticks_of_one_day(), TICK_SCHEMA)
    for unique, node in ((False, "SortAggregate"), (True, "HashAggregate")):
        text = plan(daily_bars(frame, unique_order=unique))
        assert text.count(f"{node}(key") == 2 and "partial_" in text
        assert text.index("Exchange") < text.index("partial_")


def test_frames_fall_back_to_ticks(spark):
    empty = spark.createDataFrame([], TICK)
    frames = stock_frames(empty)
    assert frames.daily is None and frames.at("daily") is empty
    full = stock_frames(spark.createDataFrame(ticks_of_one_day(), TICK_SCHEMA))
    assert full.at("raw").count() == 5 and full.at("daily").count() == 3
    assert StockFrames(raw=empty).at() is empty


def test_date_and_time_ranges_include_their_bounds(spark):
    bars = bars_of(spark, A=range(1, 11))
    assert between_dates(bars, day(3), "2024-01-05").count() == 3
    assert between_dates(bars, None, day(2)).count() == 2
    assert between_dates(bars).count() == 10
    ticks = spark.createDataFrame(ticks_of_one_day(), TICK_SCHEMA)
    assert between_times(ticks, datetime(2024, 1, 2, 11), datetime(2024, 1, 3, 9)).count() == 3
    assert between_times(ticks, "2024-01-02 15:30:00").count() == 2


def test_padded_range():
    start, end = padded_range("2024-03-01", date(2024, 3, 5))
    assert (start, end) == (datetime(2024, 2, 27), datetime(2024, 3, 6))


def test_ticker_lists(spark):
    bars = bars_of(spark, A=[1], B=[2], C=[3])
    assert rows(only_tickers(bars, "A,C").select("ticker")) == [("A",), ("C",)]
    assert only_tickers(bars, ["B"]).count() == 1
    assert only_tickers(bars, None).count() == 3
    many = ["B", *(f"T{i}" for i in range(3000))]
    assert rows(only_tickers(bars, many).select("ticker")) == [("B",)]


def latest_input(spark):
    tied = [
        ("A", day(1), 1.0, 1.0, 1.0, 1.0, 1),
        ("A", day(2), 2.0, 2.0, 2.0, 2.0, 1),
        ("A", day(2), 3.0, 3.0, 3.0, 3.0, 1),
        ("B", day(1), 4.0, 4.0, 4.0, 4.0, 1),
        ("B", None, 5.0, 5.0, 5.0, 5.0, 1),
        (None, day(9), 6.0, 6.0, 6.0, 6.0, 1),
    ]
    return spark.createDataFrame(tied, BAR_SCHEMA)


def test_latest_rows_keep_ties_and_drop_missing_keys(spark):
    frame = latest_input(spark)
    expected = [("A", 2.0), ("A", 3.0), ("B", 4.0)]
    assert rows(latest_per_key(frame).select("ticker", "close")) == expected
    assert rows(latest_by_join(frame).select("ticker", "close")) == expected


def test_rank_and_join_forms_agree(spark):
    generator = random.Random(3)
    data = [
        (generator.choice("ABCDE"), day(generator.randint(1, 9)), 0.0, 0.0, 0.0, float(i), i)
        for i in range(500)
    ]
    frame = spark.createDataFrame(data, BAR_SCHEMA)
    assert rows(latest_per_key(frame)) == rows(latest_by_join(frame).select(*frame.columns))


def test_settled_dates_are_broadcast_and_hot_rows_not_shuffled(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("ticker"),
        F.lit(day(1)).alias("date"),
        "id",
    )
    newest = settle(newest_per_key(hot), "newest")
    found = latest_by_join(hot, newest=newest)
    assert "BroadcastHashJoin" in plan(found) and "hashpartitioning" not in plan(found)
    assert found.count() == 20_000
