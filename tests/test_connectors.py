"""Kafka and JDBC jobs with the connector call replaced, as neither is present here."""

from datetime import datetime
from unittest.mock import MagicMock

import pytest
from helpers import TICK_SCHEMA, day, tick

from tickloom.plans import events as event_jobs
from tickloom.plans.market import market_job
from tickloom.schemas import KAFKA_RECORD
from tickloom.sinks.files import write_parquet
from tickloom.sinks.jdbc import write_table
from tickloom.sinks.kafka import write_topic
from tickloom.sources import (
    dispatch,
    open_ticks,
    preview_table,
    read_table,
    read_topic,
    read_topic_stream,
)
from tickloom.streaming import events as streams


def record(value, offset=0):
    return (None, bytearray(value, "utf-8"), "t", 0, offset, None, 0)


def ticks_topic(spark):
    messages = [
        f'{{"ticker":"{t}","timestamp":"2024-01-{d:02d}T10:00:00","open":1,"high":2,'
        f'"low":0.5,"close":{d},"volume":3}}'
        for t in "AB"
        for d in range(1, 21)
    ]
    return spark.createDataFrame([record(m) for m in messages], KAFKA_RECORD)


def test_topic_scans_pass_their_options():
    spark = MagicMock()
    read_topic(spark, "broker:9092", "ticks", tolerate_loss=True)
    spark.read.format.assert_called_once_with("kafka")
    options = spark.read.format.return_value.options.call_args.kwargs
    assert options["subscribe"] == "ticks" and options["endingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    read_topic_stream(spark, "broker:9092", "events")
    options = spark.readStream.format.return_value.options.call_args.kwargs
    assert options["startingOffsets"] == "earliest" and "endingOffsets" not in options


def test_table_scans_pass_their_options():
    spark = MagicMock()
    read_table(spark, "jdbc:x", "t", {"user": "u"}, partition_column="id", lower=1, upper=9, partitions=3)
    spark.read.format.assert_called_once_with("jdbc")
    options = spark.read.format.return_value.options.call_args.kwargs
    assert options["dbtable"] == "t" and options["numPartitions"] == "3" and options["user"] == "u"
    preview_table(spark, "jdbc:x", "t", rows=5)
    options = spark.read.format.return_value.options.call_args.kwargs
    assert options["dbtable"] == "(SELECT * FROM t LIMIT 5) preview"


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_table_writes_pass_their_mode(mode):
    df = MagicMock()
    write_table(df, "jdbc:x", "t", {"password": "p"}, mode=mode, connections=4)
    options = df.write.format.return_value.options.call_args.kwargs
    assert options["numPartitions"] == "4" and ("truncate" in options) == (mode == "overwrite")
    df.write.format.return_value.options.return_value.mode.assert_called_once_with(mode)


def test_topic_writes_wait_for_all_replicas(monkeypatch):
    encoded = MagicMock()
    monkeypatch.setattr("tickloom.sinks.kafka.encode_json", lambda df, key: encoded)
    write_topic(MagicMock(), "broker:9092", "user_events")
    options = encoded.write.format.return_value.options.call_args.kwargs
    assert options["kafka.acks"] == "all" and options["topic"] == "user_events"


def test_market_job_over_a_topic(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(dispatch, "read_topic", lambda *a, **k: ticks_topic(spark))
    market_job(
        spark, "kafka", str(tmp_path / "out"), "2024-01-08", "2024-01-10",
        tickers="B", servers="broker", topic="ticks", save_raw=True,
    )
    (document,) = spark.read.json(str(tmp_path / "out")).collect()
    # One day past the end at midnight still excludes the ten o'clock tick of that day.
    assert (document.ticker, document.date, document.close) == ("B", "2024-01-10", 10.0)
    raw = spark.read.parquet(str(tmp_path / "out_raw"))
    assert {r.date for r in raw.collect()} == {day(n) for n in range(5, 11)}


def test_empty_topic_reads_the_default_path_unfiltered(spark, monkeypatch, tmp_path):
    nothing = spark.createDataFrame([], KAFKA_RECORD)
    monkeypatch.setattr(dispatch, "read_topic", lambda *a, **k: nothing)
    stored = [tick("A", f"2024-01-0{d} 09:00:00", 1.0) for d in (1, 2, 3)]
    write_parquet(spark.createDataFrame(stored, TICK_SCHEMA), str(tmp_path / "stored"))
    options = {"topic": "t", "servers": "b", "start": datetime(2024, 1, 2)}
    found = open_ticks(spark, "kafka", default_path=str(tmp_path / "stored"), **options)
    assert found.count() == 3
    assert open_ticks(spark, "kafka", default_path=None, **options).isEmpty()


def test_database_ticks_are_limited_to_the_range(spark, monkeypatch):
    stored = spark.createDataFrame(
        [tick("A", f"2024-01-0{d} 09:00:00", 1.0) for d in range(1, 7)], TICK_SCHEMA
    )
    calls = []

    def fake(spark, url, table, properties, **split):
        calls.append((url, table, properties, split))
        return stored

    monkeypatch.setattr(dispatch, "read_table", fake)
    found = open_ticks(
        spark, "db", location="jdbc:x", properties={"user": "u"}, table="prices",
        start=datetime(2024, 1, 2), end=datetime(2024, 1, 4), partition_column="date",
    )
    assert found.count() == 3
    assert calls == [("jdbc:x", "prices", {"user": "u"}, {"partition_column": "date"})]


def test_events_load_replaces_the_table(spark, monkeypatch):
    written = []
    monkeypatch.setattr(
        event_jobs, "write_table", lambda df, *a: written.append((df.collect(), a))
    )
    records = spark.createDataFrame([record('{"user_id":1,"event":"login"}')], KAFKA_RECORD)
    event_jobs.load_events_table(records, "jdbc:x", properties={"user": "u"})
    ((rows, arguments),) = written
    assert rows == [(1, "login", None, None, None)]
    assert arguments == ("jdbc:x", "user_events_stream", {"user": "u"}, "overwrite")


def test_table_sink_survives_a_half_written_batch(spark, monkeypatch, tmp_path):
    table = str(tmp_path / "table")
    key = "topic string, partition int, offset bigint, "
    schema = key + "user_id int, event string, amount int, page string, event_time string"
    spark.createDataFrame([], schema).write.parquet(table)

    def append(df, url, name, properties, mode, connections):
        assert mode == "append" and connections == 2
        df.write.mode("append").parquet(table)

    looked_at = []

    def ranges(spark, url, name, conditions, properties):
        looked_at.append(conditions)
        return spark.read.schema(schema).parquet(table).filter(" OR ".join(f"({c})" for c in conditions))

    monkeypatch.setattr(streams, "read_ranges", ranges)
    monkeypatch.setattr(streams, "write_table", append)
    sink = streams.table_sink("jdbc:x", "user_events_stream", connections=2)

    def batch(first, last):
        rows = [record(f'{{"user_id":{i},"event":"login"}}', i) for i in range(first, last)]
        return streams.decoded(spark.createDataFrame(rows, KAFKA_RECORD))

    # The first attempt at a batch stored half of it before it failed.
    batch(0, 10).write.mode("append").parquet(table)
    sink(batch(0, 20), 0)
    sink(batch(0, 20), 0)
    sink(batch(20, 30), 1)
    offsets = [r.offset for r in spark.read.parquet(table).collect()]
    assert sorted(offsets) == list(range(30))
    assert looked_at[-1] == ["topic = 't' AND partition = 0 AND offset BETWEEN 20 AND 29"]
    sink(batch(0, 0), 2)
    assert len(looked_at) == 3


def test_look_up_stays_near_each_partition(spark):
    rows = [(None, None, topic, part, offset, None, 0) for topic, part, offset in
            [("t", 0, 10), ("t", 0, 12), ("t", 1, 5_000_000_000), ("o'x", 0, 7)]]
    batch = spark.createDataFrame(rows, KAFKA_RECORD)
    assert streams.offset_ranges(batch) == [
        "topic = 'o''x' AND partition = 0 AND offset BETWEEN 7 AND 7",
        "topic = 't' AND partition = 0 AND offset BETWEEN 10 AND 12",
        "topic = 't' AND partition = 1 AND offset BETWEEN 5000000000 AND 5000000000",
    ]
