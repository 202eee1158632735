"""User events as a stream: decode, route, load into a table.

A query drains what is there and stops (``availableNow``); started again from the same
checkpoint it goes on where it ended, so the checkpoint plays the part of a consumer
group. Give ``every`` to keep it running instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.decode import decode_events
from tickloom.schemas import KAFKA_RECORD
from tickloom.sinks.jdbc import write_table
from tickloom.sources.jdbc import read_ranges

# What identifies a message.
MESSAGE_KEY = ("topic", "partition", "offset")

BatchSink = Callable[[DataFrame, int], None]


def landed_records(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Kafka-shaped records from Parquet files landing in a folder."""
    reader = spark.readStream.schema(KAFKA_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def decoded(records: DataFrame) -> DataFrame:
    """Events with the topic, partition and offset they came from."""
    return decode_events(records, keep=MESSAGE_KEY)


def batch_folder_sink(path: str, unique_offsets: bool = True) -> BatchSink:
    """Append to a Parquet table with one folder per query and batch.

    The identity of a query is kept in its checkpoint. So a batch that is run again after
    a failure replaces its own folder and no other, and several queries may load into one
    table. A query with a new checkpoint is another query: what it reads again is there
    twice, and :func:`loaded_rows` leaves it out. A Kafka source never repeats an offset
    within a batch; set ``unique_offsets=False`` for sources that may, at the price of a
    shuffle.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if unique_offsets else batch.dropDuplicates(list(MESSAGE_KEY))
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows.write.mode("overwrite").parquet(f"{path}/query_id={query or 'none'}/batch_id={batch_id}")

    return write


def loaded_rows(
    spark: SparkSession, path: str, key: tuple[str, ...] | None = MESSAGE_KEY
) -> DataFrame:
    """The rows of a table, each message once although several queries may have loaded it.

    ``key=None`` skips that step, and its shuffle, where no query ever began anew.
    """
    rows = spark.read.parquet(path).drop("query_id", "batch_id")
    return rows if key is None else rows.dropDuplicates(list(key))


def new_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of a batch whose message is not stored yet.

    ``stored`` need only hold the messages near the batch, see :func:`offset_ranges`.
    """
    key = list(MESSAGE_KEY)
    return batch.dropDuplicates(key).join(stored.select(*key), key, "left_anti")


def offset_ranges(batch: DataFrame) -> list[str]:
    """For each partition of a topic in the batch, a condition for its range of offsets.

    One row for each such partition comes to the driver, however many messages there are.
    """
    ends = batch.groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    found = []
    for row in ends.orderBy("topic", "partition").collect():
        topic = row["topic"].replace("'", "''")
        place = f"topic = '{topic}' AND partition = {row['partition']}"
        found.append(f"{place} AND offset BETWEEN {row['low']} AND {row['high']}")
    return found


def table_sink(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int | None = None,
) -> BatchSink:
    """Append to a JDBC table, leaving out messages a failed attempt already stored.

    The look-up reads one range of offsets for each partition of the batch, each in a task
    of its own, and the database evaluates the range; an index on the message key keeps
    that cheap. The table must exist with the columns of the key. ``connections`` bounds
    the tasks that write at a time. Give the source a rate limit (``files_per_batch``,
    ``maxOffsetsPerTrigger``): without one, the first batch is the whole backlog.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Looked at for its offsets and then written: do not decode it twice.
        batch.persist()
        try:
            ranges = offset_ranges(batch)
            if ranges:
                stored = read_ranges(batch.sparkSession, url, table, ranges, properties)
                rows = new_rows(batch, stored)
                write_table(rows, url, table, properties, mode="append", connections=connections)
        finally:
            batch.unpersist()

    return write


def start(
    rows: DataFrame, sink: BatchSink, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def drain(rows: DataFrame, sink: BatchSink, checkpoint: str) -> None:
    """Process all there is and return; failures of the query are raised."""
    start(rows, sink, checkpoint).awaitTermination()


def load_events(
    records: DataFrame, sink: BatchSink, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Decode records and load the events through ``sink``."""
    return start(decoded(records), sink, checkpoint, every)
