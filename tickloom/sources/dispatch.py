"""Open market ticks from the source a job names."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.decode import decode_ticks
from tickloom.operators.ranges import between_dates, between_times
from tickloom.schemas import TICK
from tickloom.sources.jdbc import read_table
from tickloom.sources.kafka import read_topic


def empty_ticks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TICK)


def _default_ticks(spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def or_fallback(
    spark: SparkSession, records: DataFrame, default_path: str | None
) -> DataFrame | None:
    """None if there are records; else the ticks at the default path, else no ticks."""
    if not records.isEmpty():
        return None
    stored = _default_ticks(spark, default_path)
    return empty_ticks(spark) if stored is None else stored


def ticks_of_records(
    records: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Ticks of Kafka records, limited to the inclusive range."""
    return between_times(decode_ticks(records, keep), start, end)


def open_ticks(
    spark: SparkSession,
    kind: str,
    *,
    location: str | None = None,
    table: str = "stock_prices",
    properties: dict[str, str] | None = None,
    topic: str | None = None,
    servers: str | None = None,
    default_path: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    keep: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """Ticks from ``kafka``, ``db`` or ``file``, limited to the inclusive range.

    ``db`` without connection properties reads ``location`` as Parquet. Without a
    location the default path is read; if that does not exist either, this fails.
    ``keep`` names columns of a topic's records, such as the offset, to carry along.
    """
    if kind == "kafka":
        records = read_topic(spark, servers, topic, **options)
        stored = or_fallback(spark, records, default_path)
        if stored is not None:
            return stored
        return ticks_of_records(records, start, end, keep)
    if kind not in ("db", "file"):
        raise ValueError(f"unknown source {kind!r}; use file, db or kafka")
    if kind == "db" and location and properties:
        ticks = read_table(spark, location, table, properties, **options)
    elif location:
        ticks = spark.read.parquet(location)
    else:
        ticks = _default_ticks(spark, default_path)
        if ticks is None:
            raise ValueError(f"no location given and nothing at {default_path}")
    return between_dates(ticks, start, end)
