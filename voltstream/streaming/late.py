"""An account of rows that came too late for their window."""

from __future__ import annotations

import logging
import threading
from collections import Counter

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


class TooManyLateRows(RuntimeError):
    """More rows were late than the job's limit allows."""


class LateRows(StreamingQueryListener):
    """Sums what the stateful steps of each stream dropped behind the watermark.

    Every batch that drops rows is logged as a warning. With a ``limit``, ``wait_for``
    ends the job once a stream has dropped more; 0 allows none.

    A join or a deduplication counts single rows. A window aggregate counts what
    reaches its state: rows of one key and window that one input task has already summed
    count as one. So a count of 0 is exact, and any other says at least how many; an
    ``intake`` with ``late=`` counts and keeps every single row.
    """

    def __init__(self, limit: int | None = None):
        self.limit = limit
        self.dropped: Counter[str] = Counter()
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if rows:
            name = progress.name or str(progress.id)
            self.dropped[name] += rows
            log.warning("%s: batch %d dropped %d late rows, %d so far", name, progress.batchId, rows, self.dropped[name])

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def settle(self, query: StreamingQuery, seconds: float = 20) -> None:
        """Wait for the last reports of an ended stream, which come with some delay."""
        self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds)

    def check(self) -> None:
        """Raise if a stream is over the limit."""
        if self.limit is None:
            return
        for name, rows in self.dropped.items():
            if rows > self.limit:
                raise TooManyLateRows(f"{name}: {rows} late rows, {self.limit} allowed")
