"""Windows over series of any length: ordered ranges, blocks, and the rows before a block.

``Window.partitionBy(key)`` brings all rows of a key to one task. Here the rows are sorted
by key and order in ranges first, which numbers the rows of a long key without bringing
them together; then a long key is cut into blocks of ``block_rows``, and every block gets
the last ``reach`` rows of the one before (its halo). A frame that looks back at most
``reach`` rows finds them all in its block, so results equal those of the plain window,
and no group has more than ``block_rows + reach`` rows.

Keys with no more rows than a block stay whole. Null keys are a key of their own. Rows that
agree in key and order lie in one range; give an order that tells rows apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.workspace import settle

BLOCK_ROWS = 8_192

# Columns added to numbered rows: the place in the whole order, which grows along it.
AT = "_at"
BLOCK, HALO = "_block", "_halo"

Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], at: str = AT, ranges: int | None = None
) -> DataFrame:
    """The rows sorted by key and order over all tasks, written, with their place ``at``.

    Spark draws a sample of the sort columns first, so ``df`` should be cheap to read.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *order]
    placed = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    return settle(placed.withColumn(at, F.monotonically_increasing_id()), "ordered")


def _same(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"own.{k}").eqNullSafe(F.col(f"long.{k}")) for k in keys])


def in_blocks(
    ordered: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS, at: str = AT, block: str = BLOCK
) -> DataFrame:
    """Add ``block`` and ``_number`` to rows given by :func:`in_order`: the block of a row
    within its key, and its number there, both 0 for keys that fit a block.

    Long keys are few, at most one for every ``block_rows`` rows; only for them the rows of
    each range are counted.
    """
    counts = ordered.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    long = settle(counts.filter(F.col("_rows") > block_rows).drop("_rows"), "long")
    part = F.shiftright(F.col(at), 33)
    of_long = ordered.alias("own").join(long.alias("long"), _same(keys), "left_semi")
    pieces = of_long.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), F.min(at).alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    shifts = settle(pieces.withColumn("_shift", shift).select(*keys, "_part", "_shift"), "shifts")
    joined = ordered.alias("own").join(shifts.alias("long"), _same(keys) & (part == F.col("long._part")), "left")
    number = F.coalesce(F.col(at) + F.col("_shift"), F.lit(0))
    return joined.select("own.*", number.alias("_number")).withColumn(block, F.floor(F.col("_number") / block_rows))


def with_halo(numbered: DataFrame, reach: int, block_rows: int, block: str = BLOCK) -> DataFrame:
    """Add the last ``reach`` rows of each block to the next one, marked by ``_halo``."""
    place = lambda number, halo: F.struct(number.alias("b"), F.lit(halo).alias("h"))
    own = F.col(block)
    last = F.col("_number") % block_rows >= block_rows - reach
    places = F.when(last, F.array(place(own, False), place(own + 1, True))).otherwise(F.array(place(own, False)))
    spread = numbered.withColumn("_place", F.explode(places))
    return spread.withColumn(block, F.col("_place.b")).withColumn(HALO, F.col("_place.h")).drop("_place", "_number")


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    reach: int,
    compute: Compute,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``compute(rows, series)`` on all rows, where ``series`` is the window of a block, by
    key and in order. Frames, lags included, may look back ``reach`` rows in all: columns
    made from columns of windows add their reaches up."""
    if reach < 0 or block_rows < 1:
        raise ValueError("reach must not be negative, and a block must hold a row")
    size = max(block_rows, reach)
    numbered = in_blocks(in_order(df, keys, order), keys, size)
    rows = with_halo(numbered, reach, size)
    # Kept apart although they are few bytes: long windows are much work.
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, BLOCK)
    result = compute(rows, Window.partitionBy(*keys, BLOCK).orderBy(AT))
    return result.filter(~F.col(HALO)).drop(AT, BLOCK, HALO)
