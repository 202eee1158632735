"""Streaming queries: records land in a folder and a query drains them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.events import LOADED, ROUTED
from tickloom.catalog.views import TOPIC, event_records
from tickloom.operators.events import route_records
from tickloom.sinks.files import write_parquet
from tickloom.streaming import batch_folder_sink, drain, landed_records, load_events, loaded_rows
from tickloom.workspace import fresh_path


def _landed(spark, sf_dir):
    """The events as a stream of Kafka-shaped records."""
    landing = fresh_path(spark, "landing")
    write_parquet(event_records(spark, sf_dir), landing)
    return landed_records(spark, landing)


def _load(spark, sf_dir):
    """Two topics, each by a query of its own, loaded into one table."""
    target = fresh_path(spark, "user-events")
    sink = batch_folder_sink(target, unique_offsets=False)
    for name in (TOPIC, f"{TOPIC}_again"):
        records = _landed(spark, sf_dir).withColumn("topic", F.lit(name))
        load_events(records, sink, fresh_path(spark, "checkpoint")).awaitTermination()
    return loaded_rows(spark, target)


def _route(spark, sf_dir):
    target, checkpoint = fresh_path(spark, "messages"), fresh_path(spark, "checkpoint")
    drain(route_records(_landed(spark, sf_dir)), batch_folder_sink(target), checkpoint)
    return loaded_rows(spark, target, key=("partition", "offset"))


QUERIES = {"stream_event_load": _load, "stream_event_routing": _route}

ORACLES = {"stream_event_load": f"""
        SELECT t.topic, l.* EXCLUDE (topic)
        FROM ({LOADED}) l, (VALUES ('user_events'), ('user_events_again')) t(topic)""", "stream_event_routing": ROUTED}
