import json

import pytest
from helpers import bars_of, day

from tickloom.operators import signals as sig
from tickloom.operators.documents import documents_as_json, ticker_documents
from tickloom.operators.summary import analysed_bars, summarise_by_ticker


def documents(df):
    return {r.ticker: json.loads(r.document) for r in documents_as_json(ticker_documents(df)).collect()}


def test_document_of_a_summary(spark):
    summary = summarise_by_ticker(analysed_bars(bars_of(spark, A=range(10, 16), B=range(60, 40, -1))))
    found = documents(summary)
    assert list(found["A"]) == [
        *("ticker", "date", "open", "high", "low", "close", "volume"),
        *("ma_short", "ma_long", "ma_50", "ma_200", "rsi", "macd", "macd_signal"),
        *("macd_histogram", "trend", "ma_status", "rsi_status", "signals"),
    ]
    assert found["A"]["date"] == "2024-01-06" and found["A"]["volume"] == 100
    # No loss yet: the unknown RSI is written as zero.
    assert found["A"]["rsi"] == 0.0 and found["A"]["rsi_status"] == "unknown"
    assert found["A"]["signals"] == [
        {
            "type": "golden_cross",
            "direction": "buy",
            "strength": "medium",
            "description": "golden_cross 매수 신호 감지",
        }
    ]
    assert [s["type"] for s in found["B"]["signals"]] == ["rsi_oversold"]


def test_change_needs_an_earlier_row_with_a_price(spark):
    bars = bars_of(spark, A=[10, 12], B=[7], C=[0, 5])
    states = analysed_bars(bars).transform(sig.rsi_status).transform(sig.ma_status)
    found = documents(states)
    assert found["A"]["change_pct"] == pytest.approx(20.0)
    assert found["A"]["date"] == str(day(2))
    assert "change_pct" not in found["B"] and "change_pct" not in found["C"]


def test_missing_values(spark):
    summary = summarise_by_ticker(analysed_bars(bars_of(spark, A=[10])))
    row = summary.first().asDict() | {"close": float("nan"), "volume": None, "macd": None}
    row |= {"buy_signal": "rsi_oversold", "sell_signal": "death_cross", "signal_strength": None}
    (document,) = documents(spark.createDataFrame([row], summary.schema)).values()
    assert (document["close"], document["volume"], document["macd"]) == (0.0, 0, 0.0)
    assert [s["direction"] for s in document["signals"]] == ["buy", "sell"]
    assert document["signals"][1]["description"] == "death_cross 매도 신호 감지"
    assert document["signals"][0]["strength"] is None
