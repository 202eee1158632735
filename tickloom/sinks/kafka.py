"""Rows to Kafka messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` holds the row as JSON; missing fields are left out. ``key`` names the
    column whose text becomes the message key."""
    value = F.to_json(F.struct("*")).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def topic_write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    options = topic_write_options(servers, topic)
    encode_json(df, key).write.format("kafka").options(**options).save()
