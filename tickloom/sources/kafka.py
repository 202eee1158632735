"""Kafka scans, bounded and unbounded. The connector is given with ``--packages``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def _millis(moment: datetime) -> str:
    """Epoch milliseconds; a naive moment is UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return str(int(moment.timestamp() * 1000))


def topic_options(
    servers: str,
    topic: str,
    *,
    bounded: bool = True,
    tolerate_loss: bool = False,
    records_since: datetime | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a scan over one topic from its earliest offset.

    ``records_since`` lets the brokers skip records appended before that moment. It is
    exact for a filter on message time as long as nobody sends messages from the
    future. There is no such bound at the end: messages may arrive late.
    ``extra`` takes what the connector offers besides, such as ``minPartitions`` to
    read one hot partition with many tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if bounded:
        options["endingOffsets"] = "latest"
    if tolerate_loss:
        options["failOnDataLoss"] = "false"
    if records_since is not None:
        options["startingTimestamp"] = _millis(records_since)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    return {**options, **(extra or {})}


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The topic as it is now, from the earliest to the latest offset."""
    settings = topic_options(servers, topic, bounded=True, **options)
    return spark.read.format("kafka").options(**settings).load()


def read_topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The topic as a stream; progress lives in the checkpoint of the query."""
    settings = topic_options(servers, topic, bounded=False, **options)
    return spark.readStream.format("kafka").options(**settings).load()
