"""JDBC sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.sources.jdbc import jdbc_options


def write_options(
    url: str, table: str, properties: dict[str, str] | None = None, mode: str = "append"
) -> dict[str, str]:
    options = jdbc_options(url, table, properties)
    if mode == "overwrite":
        # Keep the table with its types, keys and grants; replace the rows only.
        options["truncate"] = "true"
    return options


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    connections: int | None = None,
) -> None:
    """Write rows to a table; ``connections`` bounds the tasks that write at a time."""
    options = write_options(url, table, properties, mode)
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").options(**options).mode(mode).save()
