"""Locations that depend on the run date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class DailyPaths:
    day: date
    landing: str
    report: str


def daily_paths(run_date: date | str, root: str = "subway", lag_days: int = 7) -> DailyPaths:
    """Where the rows of the day ``lag_days`` before the run are landed and reported."""
    if isinstance(run_date, str):
        run_date = date.fromisoformat(run_date)
    day = run_date - timedelta(days=lag_days)
    return DailyPaths(
        day=day,
        landing=f"{root}/{day:%Y%m%d}/{day:%y%m%d}.json",
        report=f"{root}/analysis/{day:%Y%m%d}.json",
    )
