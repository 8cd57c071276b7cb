"""Rows of a stream, counted on their way to the sink."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class StreamCounter(StreamingQueryListener):
    """Adds up a metric that ``counted`` puts on a stream, batch by batch.

    The metric sits below the sink, where a task that runs twice counts once. Only
    batches that were committed report it, and a batch that is replayed after a
    restart is reported once by the run that commits it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.metric = spark, f"rows-{uuid.uuid4().hex}"
        self.batches: dict[int, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def counted(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.metric, F.count(F.lit(1)).alias("n"))

    def __enter__(self) -> "StreamCounter":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def rows_of(self, query: StreamingQuery, wait: float = 60.0) -> int:
        """Rows the finished query has written. Its last report may still be on its way."""
        query.awaitTermination()
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, wait):
                raise TimeoutError("the query's end was not reported")
            return sum(self.batches.values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.metric)
        if seen is not None:
            with self._change:
                self.batches[event.progress.batchId] = seen["n"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()
