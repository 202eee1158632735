"""Small frames for tests."""

from datetime import date, datetime, timedelta

BAR_SCHEMA = (
    "ticker string, date date, open double, high double, low double, close double, volume bigint"
)
TICK_SCHEMA = (
    "ticker string, timestamp timestamp, date date, open double, high double, low double, "
    "close double, volume bigint"
)
FIRST_DAY = date(2024, 1, 1)


def day(n):
    """The n-th day, counted from 1."""
    return FIRST_DAY + timedelta(days=n - 1)


def bars_of(spark, **closes):
    """Daily bars per ticker from lists of closes."""
    rows = [
        (ticker, day(i), float(c), float(c) + 1, float(c) - 1, float(c), 100)
        for ticker, series in closes.items()
        for i, c in enumerate(series, start=1)
    ]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def tick(ticker, moment, price, volume=1):
    moment = datetime.fromisoformat(moment)
    return (ticker, moment, moment.date(), price, price + 0.5, price - 0.5, price, volume)


def by_day(df, *columns):
    """Rows of a single-ticker frame in order of date, as tuples."""
    rows = df.orderBy("ticker", "date").select(*columns).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows]
