"""Bars of a stream: late ticks, restarts, closed days, and the end of an idle query."""

import random
import threading
import time

import pytest
from helpers import TICK_SCHEMA, tick

from tickloom.operators.bars import daily_ohlcv
from tickloom.streaming import await_idle, batch_folder_sink, compact_bars, current_bars, start_bars, stream_bars
from tickloom.streaming.events import start


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("landing", "bars", "checkpoint")]


def land(spark, rows, folder):
    spark.createDataFrame(rows, TICK_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, late="2 days"):
    ticks = spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream_bars(ticks, late)


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_out_of_order_ticks_give_the_bars_of_a_table(spark, folders):
    landing, bars, checkpoint = folders
    rng = random.Random(1)
    rows = [tick(rng.choice("ABC"), f"2024-01-{1 + i // 40:02d} {i % 24:02d}:{i % 60:02d}:00", float(rng.randint(1, 99)), i) for i in range(400)]
    rows.sort(key=lambda r: r[1].timestamp() + rng.random() * 86_400)
    for part in range(4):
        land(spark, rows[100 * part : 100 * part + 100], landing)
        # Each run is a restart from the checkpoint.
        start_bars(stream(spark, landing), bars, checkpoint).awaitTermination()
    expected = daily_ohlcv(spark.createDataFrame(rows, TICK_SCHEMA))
    found = current_bars(spark, bars)
    assert rows_of(found) == rows_of(expected)
    assert found.select("ticker", "date").distinct().count() == found.count()
    start_bars(stream(spark, landing), bars, checkpoint).awaitTermination()
    assert rows_of(current_bars(spark, bars)) == rows_of(expected)
    compact_bars(spark, bars, f"{bars}-compact")
    assert rows_of(spark.read.parquet(f"{bars}-compact")) == rows_of(expected)


def test_late_ticks_change_a_bar_until_it_is_closed(spark, folders):
    landing, bars, checkpoint = folders
    steps = [
        [tick("A", "2024-01-01 10:00:00", 5.0)],
        [tick("A", "2024-01-02 10:00:00", 7.0)],
        [tick("A", "2024-01-01 09:00:00", 4.0)],  # late, the day is still open
        [tick("A", "2024-01-09 10:00:00", 9.0)],  # closes the first days
        [tick("A", "2024-01-01 08:00:00", 1.0)],  # too late
    ]
    for rows in steps:
        land(spark, rows, landing)
        start_bars(stream(spark, landing, "1 day"), bars, checkpoint).awaitTermination()
    found = {str(r.date): (r.open, r.close, r.data_points) for r in current_bars(spark, bars).collect()}
    assert found == {"2024-01-01": (4.0, 5.0, 2), "2024-01-02": (7.0, 7.0, 1), "2024-01-09": (9.0, 9.0, 1)}


def test_closed_bars_are_stored_once(spark, folders):
    landing, bars, checkpoint = folders
    for moment in ("2024-01-01 10:00:00", "2024-01-01 08:00:00", "2024-01-05 10:00:00", "2024-01-09 10:00:00"):
        land(spark, [tick("A", moment, 5.0)], landing)
        start_bars(stream(spark, landing, "1 day"), bars, checkpoint, closed_only=True).awaitTermination()
    stored = spark.read.parquet(bars)
    assert sorted((str(r.date), r.data_points) for r in stored.collect()) == [("2024-01-01", 2), ("2024-01-05", 1)]


def test_queries_are_kept_apart(spark, folders):
    landing, bars, checkpoint = folders
    land(spark, [tick("A", "2024-01-01 10:00:00", 5.0)], landing)
    ids = [start_bars(stream(spark, landing), bars, f"{checkpoint}-{i}") for i in range(2)]
    for query in ids:
        query.awaitTermination()
    with pytest.raises(ValueError, match="several queries"):
        current_bars(spark, bars)
    assert current_bars(spark, bars, str(ids[0].id)).count() == 1


def test_an_idle_query_ends_after_two_bursts(spark, folders):
    landing, table, checkpoint = folders
    land(spark, [tick("A", "2024-01-01 10:00:00", 5.0)] * 3, landing)
    ticks = spark.readStream.schema(TICK_SCHEMA).parquet(landing)
    query = start(ticks, batch_folder_sink(table), checkpoint, every="200 milliseconds")
    later = threading.Timer(2.0, land, (spark, [tick("B", "2024-01-01 11:00:00", 6.0)] * 4, landing))
    later.start()
    begin = time.monotonic()
    rows = await_idle(query, 5.0)
    assert not query.isActive and time.monotonic() - begin >= 5.0
    assert rows >= 4 and spark.read.parquet(table).count() == 7
    later.join()
