"""User-event jobs: load a topic into a table, or look into it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions import require_rows
from tickloom.operators.decode import decode_events
from tickloom.sinks.jdbc import write_table


def load_events_table(
    records: DataFrame,
    url: str,
    table: str = "user_events_stream",
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Decode the records of a topic and replace the table with them."""
    events = decode_events(require_rows(records, "topic"))
    write_table(events, url, table, properties, mode)


def inspect_events(records: DataFrame, rows: int = 10) -> DataFrame:
    """Print the first decoded events and return all of them."""
    events = decode_events(require_rows(records, "topic"))
    events.show(rows, truncate=False)
    return events
