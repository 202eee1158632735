"""The operators as queries over the test tables, with SQL to compare them with."""

from tickloom.catalog import events, files, history, market, models, reports, streams, text

_PARTS = (market, reports, events, text, files, models, streams, history)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
