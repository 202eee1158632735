"""Daily bars of a stream of ticks, by the time of the ticks.

Ticks may come late and out of order. The state of a stream holds one bar per ticker and
day, not its ticks; a late tick changes its bar until the watermark, the latest time seen
less ``late``, has passed the end of the day. Then the bar is closed, its state goes, and
ticks that come still later are left out.

There are two ways to keep the bars. :func:`bar_versions_sink` stores each bar whenever a
batch has changed it, so :func:`current_bars` also shows days that are still open. With
``closed_only`` a bar is stored once, when it is closed, and never changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import daily_ohlcv
from tickloom.schemas import DAILY_BAR_COLUMNS
from tickloom.streaming.events import BatchSink

BAR = (*DAILY_BAR_COLUMNS, "data_points")
LATE = "1 day"


def stream_bars(
    ticks: DataFrame, late: str = LATE, order_by: Sequence[str] = ("timestamp",), unique_order: bool = False
) -> DataFrame:
    """A stream of bars from a stream of ticks; days are those of the session's time zone.

    The same bars as :func:`tickloom.operators.bars.daily_ohlcv` makes of a table, and the
    same rules for ticks of equal order.
    """
    day = F.window("timestamp", "1 day")
    timed = ticks.withWatermark("timestamp", late).withColumn("date", day)
    return daily_ohlcv(timed, order_by, unique_order).withColumn("date", F.col("date.start").cast("date"))


def bar_versions_sink(path: str) -> BatchSink:
    """Store the bars a batch has changed, in a folder of the query and the batch.

    A batch that runs again after a failure replaces its own folder, so a restart from the
    checkpoint stores no bar twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{path}/query_id={query or 'none'}/batch_id={batch_id}")

    return write


def start_bars(
    bars: DataFrame, path: str, checkpoint: str, every: str | None = None, closed_only: bool = False
) -> StreamingQuery:
    """Store a stream of bars; without ``every`` it stops when all there is has been read."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    mode = "append" if closed_only else "update"
    writer = bars.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(bar_versions_sink(path)).trigger(**trigger).start()


def current_bars(spark: SparkSession, path: str, query_id: str | None = None) -> DataFrame:
    """The latest version of each bar of a query.

    A query that was begun anew, from another checkpoint, has bars of its own. If there are
    several queries in the folder, say which one; its id is kept in its checkpoint.
    """
    rows = spark.read.parquet(path)
    if query_id is None:
        names = [row["query_id"] for row in rows.select("query_id").distinct().limit(2).collect()]
        if len(names) > 1:
            raise ValueError(f"{path} holds bars of several queries; name one of them")
    else:
        rows = rows.filter(F.col("query_id") == query_id)
    latest = rows.groupBy("ticker", "date").agg(F.max_by(F.struct(*BAR), "batch_id").alias("bar"))
    return latest.select("bar.*")


def compact_bars(spark: SparkSession, path: str, target: str, query_id: str | None = None) -> None:
    """Write the latest version of each bar as a table of its own."""
    current_bars(spark, path, query_id).write.mode("overwrite").parquet(target)
