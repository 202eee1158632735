"""User-event queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.views import TOPIC, event_records, user_events
from tickloom.operators.decode import decode_events, with_parsed_time
from tickloom.operators.events import route_records
from tickloom.operators.profile import count_by
from tickloom.plans.events import inspect_events
from tickloom.schemas import USER_EVENT_BASIC
from tickloom.sinks.kafka import encode_json
from tickloom.sources.dispatch import or_fallback


def _decoded(spark, sf_dir):
    """Events decoded from their messages, the time as text and as a parsed moment."""
    events = with_parsed_time(decode_events(event_records(spark, sf_dir)))
    return events.withColumn("event_at", F.date_format("event_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _decoded_basic(spark, sf_dir):
    return decode_events(event_records(spark, sf_dir), USER_EVENT_BASIC)


def _encoded(spark, sf_dir):
    """Key and value of the messages, as text."""
    messages = encode_json(user_events(spark, sf_dir).drop("event_id"), key="user_id")
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def _counts(spark, sf_dir):
    return count_by(decode_events(event_records(spark, sf_dir)), "event")


def _fallback(spark, sf_dir):
    """A topic without messages is replaced by what is stored at the default path."""
    records = event_records(spark, sf_dir)
    nothing = records.filter(F.col("topic") != TOPIC)
    stored = or_fallback(spark, nothing, f"{sf_dir}/events.parquet")
    return stored.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


QUERIES = {
    "event_inspect": lambda spark, sf_dir: inspect_events(event_records(spark, sf_dir)),
    "event_decode": _decoded,
    "event_decode_basic": _decoded_basic,
    "event_encode": _encoded,
    "event_counts": _counts,
    "event_routing": lambda spark, sf_dir: route_records(event_records(spark, sf_dir)),
    "empty_topic_fallback": _fallback,
}

_EVENTS = """
user_events AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS user_id,
         CASE event_type WHEN 'view' THEN 'view_page' WHEN 'signup' THEN 'login'
                         WHEN 'error' THEN 'logout' ELSE event_type END AS event,
         CASE WHEN event_type = 'purchase' THEN CAST(trunc(value) AS INTEGER) END AS amount,
         CASE WHEN event_type = 'view'
              THEN 'page_' || json_extract_string(props, '$.k') END AS page,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS time_text, ts
  FROM events
), messages AS (
  SELECT *, '{"user_id":' || user_id || ',"event":"' || event || '"'
            || CASE WHEN amount IS NULL THEN '' ELSE ',"amount":' || amount END
            || CASE WHEN page IS NULL THEN '' ELSE ',"page":"' || page || '"' END
            || ',"timestamp":"' || time_text || '"}' AS value
  FROM user_events
)"""

ROUTED = f"""WITH {_EVENTS}
    SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
           CASE event WHEN 'login' THEN printf('🟢 사용자 %d가 로그인했습니다.', user_id)
                      WHEN 'logout' THEN printf('🔴 사용자 %d가 로그아웃했습니다.', user_id)
                      WHEN 'purchase' THEN printf('💰 사용자 %d가 결제했습니다.', user_id)
                      WHEN 'view_page' THEN printf('👁️ 사용자 %d가 페이지를 조회했습니다.', user_id)
                      ELSE printf('⚪ 알 수 없는 액션: %s', value) END AS message
    FROM messages"""

LOADED = f"""WITH {_EVENTS}
    SELECT 'user_events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
           event_id AS "offset", user_id, event, amount, page, time_text AS event_time
    FROM user_events"""

ORACLES = {
    "event_inspect": f"""WITH {_EVENTS}
        SELECT user_id, event, amount, page, time_text AS event_time FROM user_events""",
    "event_decode": f"""WITH {_EVENTS}
        SELECT user_id, event, amount, page, time_text AS event_time,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_at
        FROM user_events""",
    "event_decode_basic": f"""WITH {_EVENTS}
        SELECT user_id, event, time_text AS event_time FROM user_events""",
    "event_encode": f"""WITH {_EVENTS}
        SELECT CAST(user_id AS VARCHAR) AS key, value FROM messages""",
    "event_counts": f"""WITH {_EVENTS}
        SELECT event, count(*) AS count FROM user_events GROUP BY event""",
    "event_routing": ROUTED,
    "empty_topic_fallback": """
        SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events""",
}
