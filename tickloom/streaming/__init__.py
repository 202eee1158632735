from tickloom.streaming.bars import compact_bars, current_bars, start_bars, stream_bars
from tickloom.streaming.events import (
    batch_folder_sink,
    drain,
    landed_records,
    load_events,
    loaded_rows,
    new_rows,
    table_sink,
)
from tickloom.streaming.idle import await_idle

__all__ = [
    "await_idle",
    "batch_folder_sink",
    "compact_bars",
    "current_bars",
    "drain",
    "landed_records",
    "load_events",
    "loaded_rows",
    "new_rows",
    "start_bars",
    "stream_bars",
    "table_sink",
]
