"""End a continuous query when nothing has come for a while."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LastRows(StreamingQueryListener):
    """Remembers when a query last had rows, and how many rows it has had."""

    def __init__(self, run_id: str):
        self.run_id = run_id
        self.at = time.monotonic()
        self.rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) == self.run_id and progress.numInputRows > 0:
            self.at = time.monotonic()
            self.rows += progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def await_idle(query: StreamingQuery, seconds: float, poll: float = 0.2) -> int:
    """Wait until a query has had no rows for ``seconds``, then stop it.

    A batch that is being worked on counts as rows, so none is cut off however long it
    takes. Returns how many rows came while waiting. A query that ends before returns at
    once; if it failed, that is raised.
    """
    seen = LastRows(str(query.runId))
    streams = SparkSession.active().streams
    streams.addListener(seen)
    try:
        while not query.awaitTermination(poll):
            status = query.status
            if status["isTriggerActive"] and status["isDataAvailable"]:
                seen.at = time.monotonic()
            if time.monotonic() - seen.at >= seconds:
                query.stop()
    finally:
        streams.removeListener(seen)
    return seen.rows

