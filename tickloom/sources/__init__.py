from tickloom.sources.dispatch import empty_ticks, open_ticks, or_fallback
from tickloom.sources.envelope import accepted_envelopes, envelope_rows, read_envelopes
from tickloom.sources.files import (
    file_inventory,
    in_memory,
    read_csv,
    read_csv_checked,
    read_json_lines,
    read_lines,
    read_parquet,
)
from tickloom.sources.jdbc import jdbc_options, preview_table, read_table
from tickloom.sources.kafka import read_topic, read_topic_stream, topic_options
from tickloom.sources.paths import DailyPaths, daily_paths

__all__ = [
    "DailyPaths",
    "accepted_envelopes",
    "daily_paths",
    "empty_ticks",
    "envelope_rows",
    "file_inventory",
    "in_memory",
    "jdbc_options",
    "open_ticks",
    "or_fallback",
    "preview_table",
    "read_csv",
    "read_csv_checked",
    "read_envelopes",
    "read_json_lines",
    "read_lines",
    "read_parquet",
    "read_table",
    "read_topic",
    "read_topic_stream",
    "topic_options",
]
