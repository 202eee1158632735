from tickloom.sinks.files import (
    land_json,
    save,
    save_with_raw,
    write_csv,
    write_parquet,
    write_single_csv,
)
from tickloom.sinks.jdbc import write_table
from tickloom.sinks.kafka import encode_json, write_topic
from tickloom.sinks.reports import write_report, write_ticker_documents

__all__ = [
    "encode_json",
    "land_json",
    "save",
    "save_with_raw",
    "write_csv",
    "write_parquet",
    "write_report",
    "write_single_csv",
    "write_table",
    "write_ticker_documents",
    "write_topic",
]
