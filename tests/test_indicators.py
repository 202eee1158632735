"""Indicators and signals on series worked out by hand."""

import math

import pytest
from helpers import bars_of, by_day, day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickloom.operators import indicators as ind
from tickloom.operators import signals as sig
from tickloom.operators.summary import analysed_bars, summarise_by_ticker
from tickloom.params import IndicatorParams

PARAMS = IndicatorParams()


def test_moving_average_of_short_history_uses_what_exists(spark):
    df = ind.moving_averages(bars_of(spark, A=[1, 2, 3, 4]), [3])
    assert by_day(df, "ma_3") == [1.0, 1.5, 2.0, 3.0]


def test_window_list_holds_each_period_once():
    assert IndicatorParams(ma_short=50, ma_long=200).ma_windows == (50, 200)
    assert PARAMS.ma_windows == (5, 20, 50, 200)


def test_price_change_of_first_row_is_unknown(spark):
    df = ind.price_change(bars_of(spark, A=[5, 7, 6], B=[1]))
    assert by_day(df, "prev_close", "price_change") == [
        (None, None),
        (5.0, 2.0),
        (7.0, -1.0),
        (None, None),
    ]


def test_rsi_of_mixed_moves(spark):
    df = ind.rsi(bars_of(spark, A=[10, 12, 11]), 14)
    assert by_day(df, "rs")[-1] == pytest.approx(2.0)
    assert by_day(df, "rsi")[-1] == pytest.approx(100 - 100 / 3)


def test_rally_has_no_rsi(spark):
    df = analysed_bars(bars_of(spark, A=range(10, 30))).transform(sig.rsi_status)
    assert set(by_day(df, "rsi", "rsi_status", "rsi_overbought")) == {(None, "unknown", 0)}
    crosses = by_day(df, "golden_cross")
    assert [i for i, c in enumerate(crosses, 1) if c] == [6]


def test_slide_is_oversold_but_of_unknown_status(spark):
    df = analysed_bars(bars_of(spark, A=range(50, 30, -1))).transform(sig.rsi_status)
    assert by_day(df, "rsi")[1:] == [0.0] * 19
    assert sum(by_day(df, "rsi_oversold")) == 19
    assert set(by_day(df, "rsi_status")) == {"unknown"}
    assert [i for i, c in enumerate(by_day(df, "death_cross"), 1) if c] == [6]


def test_flat_series(spark):
    df = analysed_bars(bars_of(spark, A=[10.0] * 20))
    columns = ["ma_5", "ma_20", "ma_50", "ma_200", "macd", "macd_signal", "rsi"]
    assert set(by_day(df, *columns)) == {(10.0, 10.0, 10.0, 10.0, 0.0, 0.0, None)}
    flags = ["golden_cross", "death_cross", "macd_bullish_cross", "macd_bearish_cross"]
    assert set(by_day(df, *flags)) == {(0, 0, 0, 0)}
    assert set(by_day(df, "trend", "buy_signal", "signal_strength")) == {("neutral", None, None)}


def test_v_shape(spark):
    df = analysed_bars(bars_of(spark, A=[*range(60, 30, -1), *range(31, 61)]))
    assert [i for i, c in enumerate(by_day(df, "death_cross"), 1) if c] == [6]
    assert [i for i, c in enumerate(by_day(df, "golden_cross"), 1) if c] == [38]
    assert sum(by_day(df, "rsi_oversold")) == 33
    assert sum(by_day(df, "rsi_overbought")) == 3


def test_price_range_looks_back_ten_rows(spark):
    df = ind.price_range(bars_of(spark, A=range(1, 13)))
    assert by_day(df, "high_10d", "low_10d")[-1] == (13.0, 2.0)


def flags(spark, **values):
    names = ["golden_cross", "death_cross", "rsi_oversold", "rsi_overbought"]
    names += ["macd_bullish_cross", "macd_bearish_cross"]
    row = tuple(values.get(name, 0) for name in names)
    return sig.trading_signals(spark.createDataFrame([row], names)).first()


@pytest.mark.parametrize(
    "given_flags, buy, sell, strength",
    [
        ({}, None, None, None),
        ({"golden_cross": 1, "rsi_oversold": 1}, "golden_cross", None, "strong"),
        ({"golden_cross": 1, "rsi_overbought": 1}, "golden_cross", "rsi_overbought", "strong"),
        ({"death_cross": 1, "macd_bullish_cross": 1}, "macd_bullish", "death_cross", "medium"),
        ({"rsi_oversold": 1, "macd_bullish_cross": 1}, "rsi_oversold", None, "medium"),
        ({"macd_bearish_cross": 1}, None, "macd_bearish", "weak"),
    ],
)
def test_signal_priority_and_strength(spark, given_flags, buy, sell, strength):
    row = flags(spark, **given_flags)
    assert (row.buy_signal, row.sell_signal, row.signal_strength) == (buy, sell, strength)


@pytest.mark.parametrize(
    "rsi, status, overbought, oversold",
    [
        (None, "unknown", 0, 0),
        (0.0, "unknown", 0, 1),
        (29.9, "oversold", 0, 1),
        (30.0, "neutral", 0, 0),
        (70.0, "neutral", 0, 0),
        (70.1, "overbought", 1, 0),
    ],
)
def test_rsi_states(spark, rsi, status, overbought, oversold):
    df = spark.createDataFrame([(rsi,)], "rsi double")
    row = df.transform(sig.rsi_status).transform(sig.rsi_flags).first()
    assert (row.rsi_status, row.rsi_overbought, row.rsi_oversold) == (status, overbought, oversold)


def test_summary_has_one_row_per_ticker_in_the_declared_order(spark):
    bars = bars_of(spark, A=range(10, 30), B=[5])
    summary = summarise_by_ticker(analysed_bars(bars))
    assert summary.columns == [
        *("ticker", "date", "open", "high", "low", "close", "volume"),
        *("ma_5", "ma_20", "ma_50", "ma_200", "rsi", "macd", "macd_signal", "macd_histogram"),
        *("trend", "buy_signal", "sell_signal", "signal_strength"),
        *("ma_50_200_diff_pct", "rsi_status", "ma_status"),
    ]
    assert by_day(summary, "ticker", "date") == [("A", day(20)), ("B", day(1))]
    assert by_day(summary, "ma_status") == ["bullish", "neutral"]


def test_other_parameters_reach_every_step(spark):
    params = IndicatorParams(ma_short=3, ma_long=50, rsi_period=2, rsi_overbought=55.0)
    bars = bars_of(spark, A=[10, 12, 11, 13, 12, 15])
    summary = summarise_by_ticker(analysed_bars(bars, params), params)
    assert "ma_3" in summary.columns and summary.columns.count("ma_50") == 1
    row = summary.first()
    assert row.rsi == pytest.approx(100 - 100 / (1 + 3.0))
    assert row.rsi_status == "overbought"


def test_one_shuffle_serves_all_windows(spark):
    text = analysed_bars(bars_of(spark, A=[1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(ticker") == 1
    assert text.count("Sort [") == 1


def test_few_tickers_still_use_all_tasks(spark):
    bars = bars_of(spark, **{f"T{i}": [1, 2, 3] for i in range(40)})
    assert ind.by_ticker(bars).rdd.getNumPartitions() == 8
    together = ind.by_ticker(bars, 5)
    summary = summarise_by_ticker(analysed_bars(together))
    assert summary.count() == 40


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.integers(1, 50), min_size=1, max_size=40), min_size=1, max_size=4
    )
)
def test_properties_of_any_series(spark, series):
    bars = bars_of(spark, **{f"T{i}": closes for i, closes in enumerate(series)})
    rows = analysed_bars(bars).collect()
    assert len(rows) == sum(map(len, series))
    by_key = {(r.ticker, r.date): r for r in rows}
    for row in rows:
        assert row.rsi is None or 0 <= row.rsi <= 100
        assert row.golden_cross + row.death_cross <= 1
        assert row.macd_bullish_cross + row.macd_bearish_cross <= 1
        assert row.low <= row.close <= row.high
    for i, closes in enumerate(series):
        for n in range(1, len(closes) + 1):
            row = by_key[f"T{i}", day(n)]
            for window in (5, 20, 50, 200):
                frame = closes[max(0, n - window) : n]
                assert math.isclose(row[f"ma_{window}"], sum(frame) / len(frame))
            moves = [b - a for a, b in zip(closes, closes[1:n])][-14:]
            lost = -sum(m for m in moves if m < 0)
            if not lost:
                assert row.rsi is None
            else:
                gained = sum(m for m in moves if m > 0)
                assert math.isclose(row.rsi, 100 - 100 / (1 + gained / lost), abs_tol=1e-9)


def test_result_does_not_depend_on_partitions(spark):
    bars = bars_of(spark, A=range(60, 20, -1), B=[1, 5, 2, 8, 3] * 8)
    results = {
        tuple(by_day(analysed_bars(bars.repartition(n)), "ticker", "date", "rsi", "macd_signal", "trend"))
        for n in (1, 4, 9)
    }
    assert len(results) == 1
