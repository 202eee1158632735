"""Queries over ticks of any number: series in blocks, streams, rejects, layouts, days and
models from stored sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.market import ORACLES as MARKET
from tickloom.catalog.market import PARAMS, RANGE_END, RANGE_START, TICKERS, analysis_of, bars, tick_rows_sql
from tickloom.catalog.models import ORACLES as MODELS
from tickloom.catalog.models import split_sql
from tickloom.catalog.reports import ORACLES as REPORTS
from tickloom.catalog.views import LISTING_KEYS, TOPIC, event_records, event_ticks, listings, table, ticks
from tickloom.operators import indicators as ind
from tickloom.operators import means
from tickloom.operators import moments as mo
from tickloom.operators.features import with_split
from tickloom.operators.ranges import listed_tickers
from tickloom.operators.rejects import decode_or_reject
from tickloom.operators.ridership import report_lines
from tickloom.operators.tick_indicators import analysed_ticks, tick_indicators
from tickloom.plans.ridership_days import merged_usage, store_usage, stored_usage, usage_by_day
from tickloom.schemas import TICK, USER_EVENT
from tickloom.sinks.ticks import read_tick_table, write_by_ticker, write_tick_table
from tickloom.streaming import current_bars, start_bars, stream_bars
from tickloom.workspace import fresh_path, settle

KEY = ("ticker", "date")
TICK_KEYS = (*KEY, "l_orderkey", "l_linenumber", "l_partkey")


def _rounded():
    return [F.round(name, 6).alias(name) for name in ("macd_signal", "macd_histogram")]


# ------------------------------------------------------------- series of any length


def _ordered_ticks(spark, sf_dir):
    """Ticks with what the analysis reads, written once as their source is a join."""
    wanted = ticks(spark, sf_dir).select(*TICK_KEYS, "close", "high", "low", "sequence")
    return settle(wanted, "ticks")


def _tick_indicators(spark, sf_dir):
    found = tick_indicators(_ordered_ticks(spark, sf_dir), ("date", "sequence"), PARAMS)
    averages = [f"ma_{n}" for n in PARAMS.ma_windows]
    return found.select(*TICK_KEYS, "close", *averages, "avg_gain", "avg_loss", "rsi", "macd", *_rounded())


def _tick_signals(spark, sf_dir):
    found = analysed_ticks(_ordered_ticks(spark, sf_dir), ("date", "sequence"), PARAMS)
    return found.select(*TICK_KEYS, "golden_cross", "death_cross", "rsi_overbought", "rsi_oversold", "trend")


LONG = (5, 10, 20, 50, 200, 2000)


def _prefix_averages(spark, sf_dir):
    together = ind.by_ticker(bars(spark, sf_dir))
    return means.prefix_moving_averages(together, LONG).select(*KEY, "close", *(f"ma_{n}" for n in LONG))


def _prefix_rsi(spark, sf_dir):
    found = means.prefix_rsi(ind.by_ticker(bars(spark, sf_dir)), PARAMS.rsi_period)
    return found.select(*KEY, "prev_close", "gain", "loss", "avg_gain", "avg_loss", "rs", "rsi")


def _prefix_macd(spark, sf_dir):
    found = means.prefix_macd(ind.by_ticker(bars(spark, sf_dir)))
    return found.select(*KEY, "ema_fast", "ema_slow", "macd", *_rounded())


# ------------------------------------------------------------- streams and messages

SLICES = 4


def _stream_bars(spark, sf_dir):
    """Event ticks land in slices of time, each tick up to two days late; after each landing
    the stream goes on from its checkpoint."""
    given = event_ticks(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    given = given.withColumn(
        "at", F.unix_seconds("timestamp") + F.pmod(F.xxhash64("timestamp", "ticker"), F.lit(2 * 86_400))
    )
    given = settle(given, "ticks")
    span = given.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    landing, target, checkpoint = (fresh_path(spark, x) for x in ("landing", "bars", "checkpoint"))
    width = max(1, (span["high"] or 0) - (span["low"] or 0) + 1)
    part = F.floor((F.col("at") - F.lit(span["low"])) * SLICES / width)
    for i in range(SLICES):
        given.filter(part == i).select(*TICK.fieldNames()).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(TICK).parquet(landing)
        start_bars(stream_bars(arriving, late="3 days", unique_order=True), target, checkpoint).awaitTermination()
    return current_bars(spark, target)


def _damaged_records(spark, sf_dir):
    """Messages of which some are cut off, of a wrong type, without a user, or empty."""
    text = F.col("value").cast("string")
    n = F.col("offset")
    damaged = (
        F.when(n % 7 == 0, F.left(text, F.length(text) - 3))
        .when(n % 11 == 0, F.regexp_replace(text, '"user_id":', '"user_id":"u"+'))
        .when(n % 13 == 0, F.regexp_replace(text, '"user_id":[0-9]+', '"user_id":"someone"'))
        .when(n % 17 == 0, F.regexp_replace(text, '"user_id"', '"user"'))
        .when(n % 19 == 0, F.lit(""))
        .otherwise(text)
    )
    return event_records(spark, sf_dir).withColumn("value", damaged.cast("binary"))


def _decoded(spark, sf_dir):
    path = fresh_path(spark, "decoded")
    keep = ("partition", "offset")
    return decode_or_reject(_damaged_records(spark, sf_dir), USER_EVENT, path, ["user_id"], keep, ["timestamp"])


def _rejects(spark, sf_dir):
    return _decoded(spark, sf_dir).require_rows(TOPIC).rejects


def _accepted(spark, sf_dir):
    return _decoded(spark, sf_dir).rows.select("partition", "offset", "user_id", "event", "amount", "page", "timestamp")


# ------------------------------------------------------------- lists and layouts


def _listed(spark, sf_dir):
    """Ticks in a folder for each ticker, those of the tickers listed in a table."""
    path, listed = fresh_path(spark, "by-ticker"), fresh_path(spark, "listed")
    write_by_ticker(ticks(spark, sf_dir).select(*TICK_KEYS, "volume"), path)
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))
    brands.filter(F.col("ticker").isin(TICKERS.split(","))).write.parquet(listed)
    return listed_tickers(spark.read.parquet(path), spark.read.parquet(listed)).select(*TICK_KEYS, "volume")


def _bucketed(spark, sf_dir):
    """Volume and rows of each ticker in a range of days, from the table in buckets."""
    path = fresh_path(spark, "ticks")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    write_tick_table(ticks(spark, sf_dir).select(*TICK_KEYS, "close", "volume"), name, path, buckets=8)
    found = read_tick_table(spark, name, RANGE_START, RANGE_END).groupBy("ticker")
    return found.agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks"), F.max("close").alias("highest"))


# ------------------------------------------------------------- stored sums

FIRST_DAY, LAST_DAY = "1994-06-01", "1996-02-01"


def _range_report(spark, sf_dir):
    """Rides by month of sale, each month as a day: all figures are stored, two days again
    from rows that are there twice and then once more as they are; a range is reported."""
    month = F.trunc("l_shipdate", "month").alias("day")
    rows = table(spark, sf_dir, "lineitem").select(
        month, F.col("l_returnflag").alias("SBWY_ROUT_LN_NM"), F.col("l_suppkey").cast("string").alias("SBWY_STNS_NM"),
        F.col("l_quantity").cast("bigint").alias("GTON_TNOPE"), F.col("l_linenumber").cast("bigint").alias("GTOFF_TNOPE"),
    )
    root = fresh_path(spark, "subway")
    store_usage(usage_by_day(rows), root)
    again = rows.filter(F.col("day").isin("1995-01-01", "1995-02-01"))
    for landed in (again.unionByName(again), again):
        store_usage(usage_by_day(landed), root)
    return report_lines(settle(merged_usage(stored_usage(spark, root, FIRST_DAY, LAST_DAY)), "usage"))


NUMERIC = ["bedrooms", "bathrooms", "number_of_reviews"]
CATEGORICAL = ["neighbourhood_cleansed", "room_type"]
PARTS = 4


def _marked(spark, sf_dir):
    marked = with_split(listings(spark, sf_dir), LISTING_KEYS)
    return settle(marked.select(*LISTING_KEYS, *CATEGORICAL, *NUMERIC, "price", "split"), "listings")


def _moments_model(spark, sf_dir):
    """The price model from sums, stored for parts of the training rows one by one."""
    marked, path = _marked(spark, sf_dir), fresh_path(spark, "moments")
    for part in range(PARTS):
        rows = marked.filter((F.col("split") == "train") & (F.col("l_orderkey") % PARTS == part))
        mo.store_moments(mo.moments(rows, CATEGORICAL, NUMERIC, "price"), path, f"p{part}")
    model = mo.solve(mo.stored_moments(spark, path, CATEGORICAL), CATEGORICAL, NUMERIC, "price")
    found = model.predict(marked.filter("split = 'test'"))
    return found.select(*LISTING_KEYS, "price", F.round("prediction", 1).alias("prediction"))


def _many_labels(spark, sf_dir):
    """Parts as a category: a share for each part, and slopes of the numbers."""
    marked = _marked(spark, sf_dir)
    sums = mo.label_sums(marked.filter("split = 'train'"), "l_partkey", NUMERIC, "price")
    found = mo.absorb(sums, "l_partkey", NUMERIC, "price").predict(marked.filter("split = 'test'"))
    return found.select(*LISTING_KEYS, "price", F.round("prediction", 1).alias("prediction"))


QUERIES = {
    "tick_indicators": _tick_indicators,
    "tick_signals": _tick_signals,
    "prefix_moving_averages": _prefix_averages,
    "prefix_rsi": _prefix_rsi,
    "prefix_macd": _prefix_macd,
    "stream_event_bars": _stream_bars,
    "rejected_messages": _rejects,
    "accepted_messages": _accepted,
    "listed_tickers": _listed,
    "bucketed_range": _bucketed,
    "ridership_range_report": _range_report,
    "price_model_moments": _moments_model,
    "price_model_many_labels": _many_labels,
}

_TICK_ANALYSIS = f"WITH {tick_rows_sql()}, {analysis_of('date, l_orderkey, l_linenumber, l_partkey, close')}"
_KEYS = "ticker, date, l_orderkey, l_linenumber, l_partkey"
_SIGNAL = "round(macd_signal, 6) AS macd_signal, round(macd_histogram, 6) AS macd_histogram"

_MESSAGES = r"""
WITH sent AS (
  SELECT event_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS time_text,
         CASE event_type WHEN 'view' THEN 'view_page' WHEN 'signup' THEN 'login'
                         WHEN 'error' THEN 'logout' ELSE event_type END AS event,
         CASE WHEN event_type = 'purchase' THEN CAST(trunc(value) AS INTEGER) END AS amount,
         CASE WHEN event_type = 'view' THEN 'page_' || json_extract_string(props, '$.k') END AS page
  FROM events
), texts AS (
  SELECT *, '{"user_id":' || user_id || ',"event":"' || event || '"'
            || CASE WHEN amount IS NULL THEN '' ELSE ',"amount":' || amount END
            || CASE WHEN page IS NULL THEN '' ELSE ',"page":"' || page || '"' END
            || ',"timestamp":"' || time_text || '"}' AS value
  FROM sent
), damaged AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS part,
         CASE WHEN event_id % 7 = 0 THEN 'broken JSON' WHEN event_id % 11 = 0 THEN 'broken JSON'
              WHEN event_id % 13 = 0 THEN 'wrong type' WHEN event_id % 17 = 0 THEN 'missing user_id'
              WHEN event_id % 19 = 0 THEN 'no value' END AS reason
  FROM texts
)"""


def _absorbed_sql() -> str:
    """Slopes one number after the other, each relative to the means of its part."""
    columns = ["l_quantity", "l_discount", "l_tax"]
    split = split_sql("l_orderkey", "l_linenumber", "l_partkey")
    steps = [
        f"""marked AS (SELECT *, {split} AS split FROM lineitem),
        centres AS (
          SELECT l_partkey, avg(l_extendedprice) AS my, {", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(columns))}
          FROM marked WHERE split = 'train' GROUP BY l_partkey
        ), rows_0 AS (
          SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, split, l_extendedprice - my AS y,
                 my AS fit, {", ".join(f"{c} - m{i} AS x{i}" for i, c in enumerate(columns))}
          FROM marked JOIN centres USING (l_partkey)
        )"""
    ]
    for i in range(len(columns)):
        later = range(i + 1, len(columns))
        # Means of parts are taken out already, so a slope needs no intercept.
        shares = "".join(f", sum(x{k} * x{i}) / sum(x{i} * x{i}) AS share_{k}" for k in later)
        left = "".join(f", x{k} - share_{k} * x{i} AS x{k}" for k in later)
        steps.append(f"""line_{i} AS (
          SELECT sum(y * x{i}) / sum(x{i} * x{i}) AS slope{shares} FROM rows_{i} WHERE split = 'train'
        ), rows_{i + 1} AS (
          SELECT l_orderkey, l_linenumber, l_partkey, price, split, y, fit + slope * x{i} AS fit{left}
          FROM rows_{i}, line_{i}
        )""")
    return f"""WITH {", ".join(steps)}
        SELECT l_orderkey, l_linenumber, l_partkey, price, round(fit, 1) AS prediction
        FROM rows_{len(columns)} WHERE split = 'test'"""


ORACLES = {
    "tick_indicators": f"""{_TICK_ANALYSIS}
        SELECT {_KEYS}, close, ma_5, ma_20, ma_50, ma_200, avg_gain, avg_loss, rsi, macd, {_SIGNAL} FROM analysed""",
    "tick_signals": f"""{_TICK_ANALYSIS}
        SELECT {_KEYS}, golden_cross, death_cross, rsi_overbought, rsi_oversold, trend FROM analysed""",
    "prefix_moving_averages": MARKET["moving_averages"].replace(
        "ma_200 FROM analysed",
        """ma_200, avg(close) OVER (PARTITION BY ticker ORDER BY date
           ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW) AS ma_2000 FROM analysed""",
    ),
    "prefix_rsi": MARKET["rsi"],
    "prefix_macd": MARKET["macd"],
    "stream_event_bars": MARKET["event_daily_ohlcv"],
    "rejected_messages": rf"""{_MESSAGES}
        SELECT part AS partition, event_id AS "offset", reason,
               CASE WHEN event_id % 7 = 0 THEN left(value, -3)
                    WHEN event_id % 11 = 0 THEN replace(value, '"user_id":', '"user_id":"u"+')
                    WHEN event_id % 13 = 0 THEN regexp_replace(value, '"user_id":[0-9]+', '"user_id":"someone"')
                    WHEN event_id % 17 = 0 THEN replace(value, '"user_id"', '"user"') ELSE '' END AS raw
        FROM damaged WHERE reason IS NOT NULL""",
    "accepted_messages": f"""{_MESSAGES}
        SELECT part AS partition, event_id AS "offset", CAST(user_id AS INTEGER) AS user_id, event, amount, page,
               time_text AS timestamp
        FROM damaged WHERE reason IS NULL""",
    "listed_tickers": MARKET["ticker_filter"],
    "bucketed_range": """
        SELECT p_brand AS ticker, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume, count(*) AS ticks,
               max(round(l_extendedprice * 100)) AS highest
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY p_brand""",
    "ridership_range_report": REPORTS["ridership_report"].replace(
        "FROM lineitem",
        f"""FROM lineitem
  WHERE date_trunc('month', l_shipdate) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'""",
    ),
    "price_model_moments": MODELS["price_model"],
    "price_model_many_labels": _absorbed_sql(),
}
