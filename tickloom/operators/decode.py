"""JSON messages to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.schemas import TICK_MESSAGE, USER_EVENT


def decode_json(records: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Expand the JSON in ``value`` into columns.

    Broken text or a field of the wrong type gives NULL there and keeps the rest.
    ``keep`` names columns of the record, such as partition and offset, to carry along.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    return records.select(*keep, data.alias("data")).select(*keep, "data.*")


def decode_ticks(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Market ticks with the time parsed and the trading date derived from it.

    ``keep`` names columns of the record, such as the offset, that tell in what order
    ticks arrived.
    """
    parsed = F.try_to_timestamp(F.col("timestamp"))
    return (
        decode_json(records, TICK_MESSAGE, keep)
        .withColumn("timestamp", parsed)
        .withColumn("date", F.col("timestamp").cast("date"))
    )


def decode_events(
    records: DataFrame, schema: StructType = USER_EVENT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """User events; the time stays the text of the message, as ``event_time``."""
    return decode_json(records, schema, keep).withColumnRenamed("timestamp", "event_time")


def with_parsed_time(events: DataFrame, column: str = "event_time") -> DataFrame:
    """Add ``event_at``, the event time as a timestamp; unreadable text gives NULL."""
    return events.withColumn("event_at", F.try_to_timestamp(F.col(column)))
