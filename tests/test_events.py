from datetime import date, datetime

import pytest

from tickloom.functions import EmptyInputError
from tickloom.operators.decode import decode_events, decode_ticks, with_parsed_time
from tickloom.operators.events import route_events, route_records
from tickloom.plans.events import inspect_events, load_events_table
from tickloom.schemas import KAFKA_RECORD, USER_EVENT, USER_EVENT_BASIC
from tickloom.sinks.kafka import encode_json, topic_write_options


def records(spark, *values):
    rows = [
        (None, v if v is None else bytearray(v, "utf-8"), "t", 0, i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def test_broken_messages_become_missing_fields(spark):
    decoded = decode_events(
        records(
            spark,
            '{"user_id":1,"event":"login","timestamp":"2024-01-01T00:00:00"}',
            '{"user_id":"x","event":"logout"}',
            "{broken",
            None,
        ),
        keep=("offset",),
    )
    assert sorted(map(tuple, decoded.collect())) == [
        (0, 1, "login", None, None, "2024-01-01T00:00:00"),
        (1, None, "logout", None, None, None),
        (2, None, None, None, None, None),
        (3, None, None, None, None, None),
    ]


def test_basic_schema_and_parsed_time(spark):
    message = '{"user_id":1,"event":"login","amount":5,"timestamp":"2024-01-01T01:02:03.5"}'
    decoded = decode_events(records(spark, message, "{}"), USER_EVENT_BASIC)
    assert decoded.columns == ["user_id", "event", "event_time"]
    times = [r.event_at for r in with_parsed_time(decoded).collect()]
    assert sorted(times, key=str) == [datetime(2024, 1, 1, 1, 2, 3, 500000), None]


def test_ticks_keep_wide_volumes_and_unreadable_times(spark):
    decoded = decode_ticks(
        records(
            spark,
            '{"ticker":"A","timestamp":"2024-01-02T23:30:00","open":1,"volume":3000000000}',
            '{"ticker":"B","timestamp":"soon","close":2.5,"change_pct":0.1}',
        )
    ).collect()
    first, second = sorted(decoded, key=lambda r: r.ticker)
    assert (first.volume, first.date, first.open) == (3_000_000_000, date(2024, 1, 2), 1.0)
    assert (second.timestamp, second.date, second.close) == (None, None, 2.5)


def test_decode_reverses_encode(spark):
    rows = [(1, "purchase", 50, None, "t1"), (2, "view_page", None, "page_3", "t2"), (3, None, None, None, None)]
    events = spark.createDataFrame(rows, USER_EVENT)
    assert sorted(map(tuple, decode_events(encode_json(events)).collect()), key=str) == rows
    keyed = encode_json(events, key="user_id")
    assert keyed.columns == ["key", "value"]
    assert bytes(keyed.orderBy("key").first().key) == b"1"


MESSAGES = {
    '{"user_id":1,"event":"login"}': "🟢 사용자 1가 로그인했습니다.",
    '{"user_id":2,"event":"logout"}': "🔴 사용자 2가 로그아웃했습니다.",
    '{"user_id":3,"event":"purchase","amount":5}': "💰 사용자 3가 결제했습니다.",
    '{"user_id":4,"event":"view_page","page":"p"}': "👁️ 사용자 4가 페이지를 조회했습니다.",
    '{"user_id":5,"event":"click"}': '⚪ 알 수 없는 액션: {"user_id":5,"event":"click"}',
    '{"user_id":6}': '⚪ 알 수 없는 액션: {"user_id":6}',
}


def test_routing(spark):
    routed = route_records(records(spark, *MESSAGES))
    assert routed.columns == ["partition", "offset", "message"]
    assert [r.message for r in routed.orderBy("offset").collect()] == list(MESSAGES.values())


def test_routing_of_plain_events_shows_them_as_json(spark):
    events = spark.createDataFrame([(5, "scroll")], "user_id int, event string")
    assert route_events(events).first().message == (
        '⚪ 알 수 없는 액션: {"user_id":5,"event":"scroll"}'
    )


def test_empty_topic_stops_the_jobs(spark):
    with pytest.raises(EmptyInputError):
        inspect_events(records(spark))
    with pytest.raises(EmptyInputError):
        load_events_table(records(spark), "jdbc:none", "t")


def test_inspect_prints_and_returns_events(spark, capsys):
    events = inspect_events(records(spark, *MESSAGES), rows=2)
    assert "login" in capsys.readouterr().out
    assert events.count() == len(MESSAGES)


def test_topic_write_options():
    assert topic_write_options("broker:9092", "user_events") == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "user_events",
        "kafka.acks": "all",
    }
