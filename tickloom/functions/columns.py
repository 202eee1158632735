"""Small column expressions; all of them stay inside generated code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL for a zero or missing denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def percent_above(value: Column | str, base: Column | str) -> Column:
    """How many percent ``value`` lies above ``base``."""
    return (ratio(value, base) - 1.0) * 100


def zero_if_missing(column: Column | str) -> Column:
    """NULL and NaN become 0.0."""
    number = _col(column).cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def wide_key(first: Column | str, second: Column | str) -> Column:
    """Two non-negative bigints as one number, ordered by the first, then the second.

    Unlike a struct the number is of fixed width, so an aggregation that compares it can
    hash its input instead of sorting it.
    """
    wide, digits = "decimal(19,0)", F.lit("1" + "0" * 19).cast("decimal(20,0)")
    return (_col(first).cast(wide) * digits + _col(second).cast(wide)).cast("decimal(38,0)")


def day_text(column: Column | str) -> Column:
    return F.date_format(_col(column), "yyyy-MM-dd")


def lagged_day(column: Column | str, days: int = 7, pattern: str = "yyyyMMdd") -> Column:
    """The day ``days`` before, as text."""
    return F.date_format(F.date_sub(_col(column).cast("date"), days), pattern)


def initial(column: Column | str) -> Column:
    """First character in upper case; NULL for missing or empty text."""
    return F.upper(F.substring(F.nullif(_col(column), F.lit("")), 1, 1))


def _first_letters(names: pa.Array) -> pa.Array:
    return pa.array([name[:1].upper() if name else None for name in names.to_pylist()], pa.string())


# The same as `initial` as a Python function over Arrow batches; prefer `initial`.
initial_udf = F.arrow_udf(_first_letters, StringType())
