"""Messages about what users did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.decode import decode_events

# Message texts by event, and the text for any other event.
KNOWN_EVENTS = {
    "login": "🟢 사용자 %s가 로그인했습니다.",
    "logout": "🔴 사용자 %s가 로그아웃했습니다.",
    "purchase": "💰 사용자 %s가 결제했습니다.",
    "view_page": "👁️ 사용자 %s가 페이지를 조회했습니다.",
}
UNKNOWN_EVENT = "⚪ 알 수 없는 액션: %s"


def event_message(payload: Column) -> Column:
    """Text for the event; an unknown or missing event shows its payload."""
    message = F.format_string(UNKNOWN_EVENT, payload)
    for event, text in KNOWN_EVENTS.items():
        known = F.format_string(text, F.col("user_id"))
        message = F.when(F.col("event") == event, known).otherwise(message)
    return message


def route_events(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """Add ``message``. Unknown events show ``payload``, by default the event as JSON."""
    if payload is None:
        payload = F.to_json(F.struct(*events.columns))
    return events.withColumn("message", event_message(payload))


def route_records(records: DataFrame) -> DataFrame:
    """Partition, offset and message of Kafka records, batch or stream."""
    origin = ("partition", "offset", "value")
    events = decode_events(records, keep=origin)
    routed = route_events(events, payload=F.col("value").cast("string"))
    return routed.select("partition", "offset", "message")
