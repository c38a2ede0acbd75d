"""Throughput of streams: rows per second of each micro-batch, kept by a listener."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQueryListener


class Throughput(StreamingQueryListener):
    """Add with spark.streams.addListener; rates holds (query, batch, rows, rows per second)."""

    def __init__(self, most: int = 1000) -> None:
        self.rates: list[tuple[str, int, int, float]] = []
        self.most = most

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rates = [*self.rates, (str(p.id), p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0)][-self.most :]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
