"""Market, ridership and event analytics as plain PySpark DataFrame operators."""

from tickloom.params import IndicatorParams
from tickloom.session import build_session

__all__ = ["IndicatorParams", "build_session"]
