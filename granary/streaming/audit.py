"""Run rows from running streams: a listener records every micro-batch and the end of every query, failures included."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

RUNS = "run_id string, query string, batch_id bigint, started_at string, duration_ms bigint, input_rows bigint, status string, error string"


class RunAudit(StreamingQueryListener):
    """Add with ``spark.streams.addListener``. The run id is Spark's id of the query run and serves as correlation id.

    Rows are a few per micro-batch; ``flush`` appends those since the last call to a Parquet folder.
    """

    def __init__(self):
        self._lock, self._rows, self._names, self._ended = threading.Lock(), [], {}, set()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._rows.append((str(p.runId), p.name or str(p.id), p.batchId, p.timestamp, int(p.batchDuration), int(p.numInputRows), "SUCCESS", None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._lock:
            if event.exception:
                self._rows.append((run, self._names.get(run, str(event.id)), None, None, None, None, "FAILED", event.exception.strip().split("\n")[0][:500]))
            self._ended.add(run)

    def wait(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Until all events of an ended query have arrived; they come a little later than the query ends."""
        until = time.time() + seconds
        while str(query.runId) not in self._ended and time.time() < until:
            time.sleep(0.05)

    def rows(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._rows), RUNS)

    def flush(self, spark: SparkSession, path: str) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(path)
