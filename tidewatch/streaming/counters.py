"""Totals of observed metrics over all micro-batches of running queries."""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Counters(StreamingQueryListener):
    """Adds up what taps and the decoding observe, by query name and observation.

    A query's own progress reports reach back a hundred triggers; a listener sees each of them. Add it
    before the queries start, and take it off with ``close``. NULL values count as 0.
    """

    def __init__(self, spark: SparkSession):
        super().__init__()
        self._spark = spark
        self._lock = threading.Lock()
        self._totals: dict[tuple[str, str], dict[str, float]] = defaultdict(lambda: defaultdict(int))
        self._rows: dict[str, int] = defaultdict(int)
        self._ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._ended.discard(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            self._rows[progress.name] += max(progress.numInputRows, 0)
            for observation, row in progress.observedMetrics.items():
                totals = self._totals[(progress.name, observation)]
                for metric, value in row.asDict().items():
                    totals[metric] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def settled(self, query: StreamingQuery, seconds: float = 30.0) -> Counters:
        """Wait until the reports of a query that has ended are all in."""
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline:
            with self._lock:
                if str(query.runId) in self._ended:
                    return self
            time.sleep(0.05)
        raise TimeoutError(f"the end of query {query.name} was not reported within {seconds} s")

    def totals(self, query_name: str, observation: str) -> dict[str, float]:
        """Sums of the metrics of an observation of a query, over all its triggers so far."""
        with self._lock:
            return dict(self._totals[(query_name, observation)])

    def rows(self, query_name: str) -> int:
        """Records that a query has read so far."""
        with self._lock:
            return self._rows[query_name]

    def close(self) -> None:
        self._spark.streams.removeListener(self)
