from tickloom.functions.columns import (
    day_text,
    flag,
    initial,
    initial_udf,
    lagged_day,
    percent_above,
    ratio,
    wide_key,
    zero_if_missing,
)
from tickloom.functions.guards import EmptyInputError, require_columns, require_rows

__all__ = [
    "EmptyInputError",
    "day_text",
    "flag",
    "initial",
    "initial_udf",
    "lagged_day",
    "percent_above",
    "ratio",
    "require_columns",
    "require_rows",
    "wide_key",
    "zero_if_missing",
]
