"""Market queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.views import TICK_ORDER, event_ticks, tick_messages, ticks
from tickloom.functions import percent_above
from tickloom.operators import indicators as ind
from tickloom.operators import signals as sig
from tickloom.operators.bars import daily_bars, daily_ohlcv, stock_frames
from tickloom.operators.decode import decode_ticks
from tickloom.operators.documents import documents_as_json, ticker_documents
from tickloom.operators.latest import latest_by_join, latest_per_key, newest_per_key
from tickloom.operators.profile import max_by_key
from tickloom.operators.ranges import between_dates, between_times, only_tickers, padded_range
from tickloom.operators.summary import analysed_bars, summarise_by_ticker
from tickloom.params import IndicatorParams
from tickloom.plans.market import market_job, market_summary
from tickloom.sinks.files import save, write_parquet
from tickloom.sources.dispatch import ticks_of_records
from tickloom.workspace import fresh_path, settle

PARAMS = IndicatorParams()
RANGE_START, RANGE_END = "1997-01-01", "1998-12-31"
TICKERS = "Brand#1,Brand#7,Brand#20"
KEY = ("ticker", "date")


def bars(spark, sf_dir):
    return daily_bars(ticks(spark, sf_dir), **TICK_ORDER)


def _over_bars(*steps, columns):
    """A query that applies steps to the daily bars and shows some columns."""

    def query(spark, sf_dir):
        df = ind.by_ticker(bars(spark, sf_dir))
        for step in steps:
            df = df.transform(step)
        return df.select(*KEY, *columns)

    return query


def _ohlcv(spark, sf_dir):
    return daily_ohlcv(ticks(spark, sf_dir), **TICK_ORDER)


def _event_ohlcv(spark, sf_dir):
    return daily_ohlcv(event_ticks(spark, sf_dir), unique_order=True)


def _stock_frames(spark, sf_dir):
    frames = stock_frames(event_ticks(spark, sf_dir), unique_order=True)
    return frames.at("daily")


def _bars_in_range(spark, sf_dir):
    return between_dates(bars(spark, sf_dir), RANGE_START, RANGE_END)


def _ticks_in_padded_range(spark, sf_dir):
    start, end = padded_range(RANGE_START, RANGE_END)
    found = between_times(ticks(spark, sf_dir), start, end)
    return found.select(*KEY, "l_orderkey", "l_linenumber", "l_partkey", "close")


def _ticks_of_tickers(spark, sf_dir):
    found = only_tickers(ticks(spark, sf_dir), TICKERS)
    return found.select(*KEY, "l_orderkey", "l_linenumber", "l_partkey", "volume")


def _rsi_chain(df):
    return ind.rsi(df, PARAMS.rsi_period)


def _latest(spark, sf_dir):
    together = ind.by_ticker(bars(spark, sf_dir))
    return latest_per_key(ind.moving_averages(together, PARAMS.ma_windows))


def _latest_ticks(spark, sf_dir):
    columns = (*KEY, "l_orderkey", "l_linenumber", "l_partkey", "close")
    found = ticks(spark, sf_dir).select(*columns)
    return latest_by_join(found, newest=settle(newest_per_key(found), "newest"))


def _last_date(spark, sf_dir):
    return max_by_key(ticks(spark, sf_dir), "ticker", "date", "latest_date")


def _spread(df):
    return df.withColumn("ma_50_200_diff_pct", percent_above("ma_50", "ma_200"))


def analysed(spark, sf_dir):
    return analysed_bars(bars(spark, sf_dir), PARAMS)


def _rounded_summary(summary):
    noisy = {n: F.round(n, 6) for n in ("macd_signal", "macd_histogram")}
    return summary.withColumns(noisy)


def ticker_summary(spark, sf_dir):
    return _rounded_summary(summarise_by_ticker(analysed(spark, sf_dir), PARAMS))


def market_flagship(spark, sf_dir):
    """Ticks to bars, short and long average, latest row and state of each ticker."""
    together = ind.by_ticker(bars(spark, sf_dir))
    averages = ind.moving_averages(together, (PARAMS.ma_short, PARAMS.ma_long))
    return sig.ma_status(latest_per_key(averages), PARAMS)


def _event_summary(spark, sf_dir):
    daily = daily_bars(event_ticks(spark, sf_dir), unique_order=True)
    return _rounded_summary(summarise_by_ticker(analysed_bars(daily, PARAMS), PARAMS))


def _market_job(spark, sf_dir, save_raw=False):
    """The whole job over stored ticks of some tickers in a date range."""
    source, output = fresh_path(spark, "ticks"), fresh_path(spark, "summary")
    write_parquet(ticks(spark, sf_dir), source)
    market_job(
        spark,
        "file",
        output,
        RANGE_START,
        RANGE_END,
        tickers=TICKERS,
        fmt="parquet",
        save_raw=save_raw,
        params=PARAMS,
        location=source,
        **TICK_ORDER,
    )
    return output


def _job_summary(spark, sf_dir):
    return _rounded_summary(spark.read.parquet(_market_job(spark, sf_dir)))


def _topic_summary(spark, sf_dir):
    """The job over a topic, from records to JSON documents, with the volume as it was."""
    output = fresh_path(spark, "documents")
    found = ticks_of_records(tick_messages(spark, sf_dir))
    summary = settle(market_summary(found, PARAMS, unique_order=True), "summary")
    save(summary, output, "json", PARAMS)
    # Every ticker has its document; all other columns are those of the summary.
    written = spark.read.schema("ticker string").json(output)
    kept = _rounded_summary(summary).join(written, "ticker", "left_semi")
    return kept.withColumn("volume", F.col("volume") % 3_000_000_000)


def _job_raw_ticks(spark, sf_dir):
    raw = spark.read.parquet(f"{_market_job(spark, sf_dir, save_raw=True)}_raw")
    return raw.select(*KEY, "l_orderkey", "l_linenumber", "l_partkey", "volume")


DOCUMENT = """
    ticker string, date string, open double, high double, low double, close double,
    volume bigint, ma_short double, ma_long double, ma_50 double, ma_200 double, rsi double,
    macd double, macd_signal double, macd_histogram double, trend string, ma_status string,
    rsi_status string, change_pct double,
    signals array<struct<type: string, direction: string, strength: string, description: string>>
"""


def _documents(spark, sf_dir):
    """Documents of all bars as JSON, read back; one row per signal, or one without."""
    states = analysed(spark, sf_dir).transform(sig.rsi_status).transform(sig.ma_status)
    texts = documents_as_json(ticker_documents(states, PARAMS))
    parsed = texts.select(F.from_json("document", DOCUMENT).alias("d")).select("d.*")
    flat = parsed.select("*", F.explode_outer("signals").alias("signal")).drop("signals")
    noisy = {n: F.round(n, 6) for n in ("macd_signal", "macd_histogram", "change_pct")}
    return flat.select(
        "*",
        F.col("signal.type").alias("signal_type"),
        F.col("signal.direction").alias("signal_direction"),
        F.col("signal.strength").alias("signal_strength"),
        F.col("signal.description").alias("signal_description"),
    ).drop("signal").withColumns(noisy)


def _decoded_ticks(spark, sf_dir):
    decoded = decode_ticks(tick_messages(spark, sf_dir))
    iso = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    prices = ("open", "high", "low", "close")
    return decoded.select("ticker", iso.alias("tick_time"), "date", *prices, "volume", "change_pct")


AVERAGES = [f"ma_{n}" for n in PARAMS.ma_windows]

QUERIES = {
    "market_flagship": market_flagship,
    "daily_ohlcv": _ohlcv,
    "event_daily_ohlcv": _event_ohlcv,
    "stock_frames": _stock_frames,
    "date_range_bars": _bars_in_range,
    "padded_range_ticks": _ticks_in_padded_range,
    "ticker_filter": _ticks_of_tickers,
    "tick_decode": _decoded_ticks,
    "moving_averages": _over_bars(
        ind.moving_averages, columns=["close", "ma_5", "ma_10", "ma_20", "ma_50", "ma_200"]
    ),
    "price_change": _over_bars(ind.price_change, columns=["close", "prev_close", "price_change"]),
    "rsi": _over_bars(
        _rsi_chain, columns=["prev_close", "gain", "loss", "avg_gain", "avg_loss", "rs", "rsi"]
    ),
    "rsi_flags": _over_bars(
        _rsi_chain, sig.rsi_flags, columns=["rsi", "rsi_overbought", "rsi_oversold"]
    ),
    "rsi_status": _over_bars(_rsi_chain, sig.rsi_status, columns=["rsi", "rsi_status"]),
    "macd": lambda spark, sf_dir: bars(spark, sf_dir)
    .transform(ind.by_ticker)
    .transform(ind.macd)
    .select(
        *KEY,
        "ema_fast",
        "ema_slow",
        "macd",
        F.round("macd_signal", 6).alias("macd_signal"),
        F.round("macd_histogram", 6).alias("macd_histogram"),
    ),
    "market_indicators": lambda spark, sf_dir: bars(spark, sf_dir)
    .transform(ind.by_ticker)
    .transform(ind.indicators, PARAMS)
    .select(
        *KEY,
        *AVERAGES,
        "rsi",
        "macd",
        F.round("macd_signal", 6).alias("macd_signal"),
        F.round("macd_histogram", 6).alias("macd_histogram"),
    ),
    "ma_crossovers": _over_bars(
        ind.moving_averages,
        sig.ma_crossovers,
        columns=["prev_ma_5", "prev_ma_20", "golden_cross", "death_cross"],
    ),
    "macd_crossovers": _over_bars(
        ind.macd,
        sig.macd_crossovers,
        columns=["prev_macd", "macd_bullish_cross", "macd_bearish_cross"],
    ),
    "price_range_10": _over_bars(ind.price_range, columns=["high_10d", "low_10d"]),
    "trend": _over_bars(ind.moving_averages, sig.trend, columns=["close", "trend"]),
    "ma_status": _over_bars(ind.moving_averages, sig.ma_status, columns=["close", "ma_status"]),
    "ma_spread": _over_bars(ind.moving_averages, _spread, columns=["ma_50_200_diff_pct"]),
    "trading_signals": lambda spark, sf_dir: analysed(spark, sf_dir).select(
        *KEY, "trend", "buy_signal", "sell_signal", "signal_strength"
    ),
    "last_tick_date": _last_date,
    "latest_per_ticker": _latest,
    "latest_ticks": _latest_ticks,
    "ticker_summary": ticker_summary,
    "event_ticker_summary": _event_summary,
    "ticker_document": _documents,
    "market_job": _job_summary,
    "market_job_raw": _job_raw_ticks,
    "market_job_topic": _topic_summary,
}

# ---------------------------------------------------------------------------- SQL

_TICKS = """
ticks AS (
  SELECT p_brand AS ticker, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS date,
         round(l_extendedprice * 100) AS price,
         round(l_extendedprice * 100) * (1 + l_tax) AS high,
         round(l_extendedprice * 100) * (1 - l_discount) AS low,
         CAST(l_quantity AS BIGINT) AS volume, l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

_BARS = """
bars AS (
  SELECT ticker, date,
         arg_min(price, row(ts, l_orderkey, l_linenumber, l_partkey, price)) AS open,
         max(high) AS high, min(low) AS low,
         arg_max(price, row(ts, l_orderkey, l_linenumber, l_partkey, price)) AS close,
         CAST(sum(volume) AS BIGINT) AS volume, count(*) AS data_points
  FROM ticks GROUP BY ticker, date
)"""

_EVENT_BARS = """
bars AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
         arg_min(round(value * 100), ts) AS open, max(round(value * 100)) AS high,
         min(round(value * 100)) AS low, arg_max(round(value * 100), ts) AS close,
         CAST(sum(user_id) AS BIGINT) AS volume, count(*) AS data_points
  FROM events GROUP BY ALL
)"""


def _mean(column: str, rows: int) -> str:
    return (
        f"avg({column}) OVER (PARTITION BY ticker ORDER BY date "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )


def _lag(column: str) -> str:
    return f"lag({column}) OVER (PARTITION BY ticker ORDER BY date)"


def _order_of(first: str, second: str, third: str) -> str:
    """Bullish if the three fall in that order, bearish if they rise, else neutral."""
    return (
        f"CASE sign({first} - {second}) + sign({second} - {third}) "
        "WHEN 2 THEN 'bullish' WHEN -2 THEN 'bearish' ELSE 'neutral' END"
    )


def _bit(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def _crossed(upper: str, lower: str) -> str:
    """+1 where ``upper`` came to lie above ``lower``, -1 where it came to lie below."""
    now, before = f"sign({upper} - {lower})", f"sign(prev_{upper} - prev_{lower})"
    return f"CASE WHEN {now} * {before} <= 0 THEN {now} END"


def _first(*flags: tuple[str, str]) -> str:
    return "coalesce(" + ", ".join(f"if({f} = 1, '{label}', NULL)" for f, label in flags) + ")"


_HIGH_10 = "max(high) OVER (PARTITION BY ticker ORDER BY date ROWS 9 PRECEDING)"
_LOW_10 = "min(low) OVER (PARTITION BY ticker ORDER BY date ROWS 9 PRECEDING)"

# Every column of the analysis, one step per table.
_ANALYSIS = f"""
averages AS (
  SELECT *, {", ".join(f"{_mean('close', n)} AS ma_{n}" for n in (5, 10, 20, 50, 200))},
         {_lag("close")} AS prev_close,
         {_mean("close", 12)} AS ema_fast, {_mean("close", 26)} AS ema_slow,
         {_HIGH_10} AS high_10d, {_LOW_10} AS low_10d
  FROM bars
), changes AS (
  SELECT *, close - prev_close AS price_change, ema_fast - ema_slow AS macd,
         {_lag("ma_5")} AS prev_ma_5, {_lag("ma_20")} AS prev_ma_20
  FROM averages
), moves AS (
  SELECT *, greatest(price_change, 0.0::DOUBLE) AS gain,
         greatest(-price_change, 0.0::DOUBLE) + 0.0 AS loss,
         {_mean("macd", 9)} AS macd_signal, {_lag("macd")} AS prev_macd
  FROM changes
), means AS (
  SELECT *, {_mean("gain", 14)} AS avg_gain, {_mean("loss", 14)} AS avg_loss,
         {_lag("macd_signal")} AS prev_macd_signal, macd - macd_signal AS macd_histogram
  FROM moves
), strengths AS (
  SELECT *, avg_gain / nullif(avg_loss, 0) AS rs FROM means
), indices AS (
  SELECT *, 100 - 100 / (1 + rs) AS rsi, {_crossed("ma_5", "ma_20")} AS ma_move,
         {_crossed("macd", "macd_signal")} AS macd_move
  FROM strengths
), flags AS (
  SELECT *, {_bit("ma_move = 1")} AS golden_cross, {_bit("ma_move = -1")} AS death_cross,
         {_bit("rsi > 70")} AS rsi_overbought, {_bit("rsi < 30")} AS rsi_oversold,
         {_bit("macd_move = 1")} AS macd_bullish_cross,
         {_bit("macd_move = -1")} AS macd_bearish_cross,
         {_order_of("close", "ma_50", "ma_200")} AS trend,
         {_order_of("close", "ma_5", "ma_20")} AS ma_status,
         if(coalesce(rsi, 0) = 0, 'unknown',
            if(rsi > 70, 'overbought', if(rsi < 30, 'oversold', 'neutral'))) AS rsi_status,
         (ma_50 / ma_200 - 1.0) * 100 AS ma_50_200_diff_pct
  FROM indices
), analysed AS (
  SELECT *,
         {_first(("golden_cross", "golden_cross"), ("rsi_oversold", "rsi_oversold"),
                 ("macd_bullish_cross", "macd_bullish"))} AS buy_signal,
         {_first(("death_cross", "death_cross"), ("rsi_overbought", "rsi_overbought"),
                 ("macd_bearish_cross", "macd_bearish"))} AS sell_signal,
         CASE (golden_cross | death_cross) + (rsi_oversold | rsi_overbought)
              WHEN 2 THEN 'strong' WHEN 1 THEN 'medium'
              ELSE if(macd_move <> 0, 'weak', NULL) END AS signal_strength
  FROM flags
)"""



def analysis_of(order: str) -> str:
    """The analysis of ``bars`` with rows of a ticker in another order than by date."""
    return _ANALYSIS.replace("ORDER BY date", f"ORDER BY {order}")


def tick_rows_sql() -> str:
    """Ticks in the place of bars."""
    return f"{_TICKS}, bars AS (SELECT *, price AS close FROM ticks)"


_LATEST = "WHERE (ticker, date) IN (SELECT (ticker, max(date)) FROM bars GROUP BY ticker)"

_SUMMARY = f"""
  SELECT ticker, date, open, high, low, close, volume, ma_5, ma_20, ma_50, ma_200, rsi, macd,
         round(macd_signal, 6) AS macd_signal, round(macd_histogram, 6) AS macd_histogram,
         trend, buy_signal, sell_signal, signal_strength, ma_50_200_diff_pct, rsi_status, ma_status
  FROM analysed {_LATEST}"""


def _sql(select: str) -> str:
    return f"WITH {_TICKS}, {_BARS}, {_ANALYSIS} {select}"


def _columns(*names: str) -> str:
    return _sql(f"SELECT ticker, date, {', '.join(names)} FROM analysed")


_ROUNDED = "round(macd_signal, 6) AS macd_signal, round(macd_histogram, 6) AS macd_histogram"

ORACLES = {
    "market_flagship": _sql(
        f"""SELECT ticker, date, open, high, low, close, volume, ma_5, ma_20, ma_status
            FROM analysed {_LATEST}"""
    ),
    "daily_ohlcv": f"WITH {_TICKS}, {_BARS} SELECT * FROM bars",
    "event_daily_ohlcv": f"WITH {_EVENT_BARS} SELECT * FROM bars",
    "stock_frames": f"WITH {_EVENT_BARS} SELECT * EXCLUDE (data_points) FROM bars",
    "date_range_bars": f"""WITH {_TICKS}, {_BARS} SELECT * EXCLUDE (data_points) FROM bars
        WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""",
    "padded_range_ticks": f"""WITH {_TICKS}
        SELECT ticker, date, l_orderkey, l_linenumber, l_partkey, price AS close FROM ticks
        WHERE ts BETWEEN TIMESTAMP '1996-12-29' AND TIMESTAMP '1999-01-01'""",
    "ticker_filter": f"""WITH {_TICKS}
        SELECT ticker, date, l_orderkey, l_linenumber, l_partkey, volume FROM ticks
        WHERE ticker IN ('Brand#1', 'Brand#7', 'Brand#20')""",
    "tick_decode": """
        SELECT event_type AS ticker, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS tick_time,
               CAST(ts AS DATE) AS date, round(value * 100) AS open, round(value * 100) AS high,
               round(value * 100) AS low, round(value * 100) AS close,
               user_id + 3000000000 AS volume, CAST(NULL AS DOUBLE) AS change_pct
        FROM events""",
    "moving_averages": _columns("close", "ma_5", "ma_10", "ma_20", "ma_50", "ma_200"),
    "price_change": _columns("close", "prev_close", "price_change"),
    "rsi": _columns("prev_close", "gain", "loss", "avg_gain", "avg_loss", "rs", "rsi"),
    "rsi_flags": _columns("rsi", "rsi_overbought", "rsi_oversold"),
    "rsi_status": _columns("rsi", "rsi_status"),
    "macd": _columns("ema_fast", "ema_slow", "macd", _ROUNDED),
    "market_indicators": _columns("ma_5", "ma_20", "ma_50", "ma_200", "rsi", "macd", _ROUNDED),
    "ma_crossovers": _columns("prev_ma_5", "prev_ma_20", "golden_cross", "death_cross"),
    "macd_crossovers": _columns("prev_macd", "macd_bullish_cross", "macd_bearish_cross"),
    "price_range_10": _columns("high_10d", "low_10d"),
    "trend": _columns("close", "trend"),
    "ma_status": _columns("close", "ma_status"),
    "ma_spread": _columns("ma_50_200_diff_pct"),
    "trading_signals": _columns("trend", "buy_signal", "sell_signal", "signal_strength"),
    "last_tick_date": f"""WITH {_TICKS}
        SELECT ticker, max(date) AS latest_date FROM ticks GROUP BY ticker""",
    "latest_per_ticker": _sql(
        f"""SELECT ticker, date, open, high, low, close, volume, ma_5, ma_20, ma_50, ma_200
            FROM analysed {_LATEST}"""
    ),
    "latest_ticks": f"""WITH {_TICKS},
        newest AS (SELECT ticker, max(date) AS date FROM ticks GROUP BY ticker)
        SELECT ticker, date, l_orderkey, l_linenumber, l_partkey, price AS close
        FROM ticks JOIN newest USING (ticker, date)""",
    "ticker_summary": _sql(_SUMMARY),
    "event_ticker_summary": f"WITH {_EVENT_BARS}, {_ANALYSIS} {_SUMMARY}",
    "ticker_document": _sql(
        f"""
        , found AS (
          SELECT *, (close - prev_close) / prev_close * 100 AS change
          FROM analysed {_LATEST}
        ), signals AS (
          SELECT ticker, buy_signal AS signal_type, 'buy' AS signal_direction, signal_strength,
                 buy_signal || ' 매수 신호 감지' AS signal_description
          FROM found WHERE buy_signal IS NOT NULL
          UNION ALL
          SELECT ticker, sell_signal, 'sell', signal_strength, sell_signal || ' 매도 신호 감지'
          FROM found WHERE sell_signal IS NOT NULL
        )
        SELECT found.ticker, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume,
               ma_5 AS ma_short, ma_20 AS ma_long, ma_50, ma_200, coalesce(rsi, 0) AS rsi, macd,
               {_ROUNDED}, trend, ma_status, rsi_status,
               round(CASE WHEN prev_close > 0 THEN change END, 6) AS change_pct,
               signal_type, signal_direction, signals.signal_strength, signal_description
        FROM found LEFT JOIN signals ON found.ticker = signals.ticker"""
    ),
    "market_job_raw": f"""WITH {_TICKS}
        SELECT ticker, date, l_orderkey, l_linenumber, l_partkey, volume FROM ticks
        WHERE date BETWEEN DATE '1996-12-29' AND DATE '1999-01-01'
          AND ticker IN ('Brand#1', 'Brand#7', 'Brand#20')""",
}

# The whole summary, over the ticks of the job only.
_JOB_TICKS = _TICKS.replace(
    "ON l_partkey = p_partkey",
    """ON l_partkey = p_partkey
  WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-12-29' AND DATE '1999-01-01'
    AND p_brand IN ('Brand#1', 'Brand#7', 'Brand#20')""",
)
ORACLES["market_job"] = ORACLES["ticker_summary"].replace(_TICKS, _JOB_TICKS)
ORACLES["market_job_topic"] = ORACLES["event_ticker_summary"]
