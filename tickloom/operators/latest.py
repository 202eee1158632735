"""The latest rows of each key, with all ties; rows without key or date drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """For frames with a bounded number of rows per key and date, such as daily bars.

    Tasks drop all but their own latest rows before the shuffle, and after another
    window over the same key there is no shuffle at all.
    """
    newest_first = Window.partitionBy(key).orderBy(F.desc(order))
    return (
        df.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
        .withColumn("_rank", F.rank().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def newest_per_key(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    return (
        df.filter(F.col(order).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(order).alias("_newest"))
    )


def latest_by_join(
    df: DataFrame,
    key: str = "ticker",
    order: str = "date",
    newest: DataFrame | None = None,
) -> DataFrame:
    """The same rows for frames where one key and date may hold any number of rows.

    The newest date per key is joined back to the rows. Pass :func:`newest_per_key`
    settled as a table: one row per key, which Spark then broadcasts if it is below the
    threshold, so that the rows are neither shuffled nor sorted; above it, hot keys of
    the shuffled rows are split.
    """
    if newest is None:
        newest = newest_per_key(df, key, order)
    matches = (F.col(key) == F.col("_key")) & (F.col(order) == F.col("_newest"))
    return df.join(newest, matches).drop("_key", "_newest")
