"""What a stream did, batch by batch, as a table: counts observed while data flowed, rows and times of phases, state."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query string, batch bigint, reported string, part string, name string, value bigint"


def _rows(progress) -> list[tuple[str, str, int]]:
    """(part, name, value) of one micro-batch. Counts go by the name of their observation."""
    found = [("source", "rows", progress.numInputRows)]
    found += [("duration-ms", phase, millis) for phase, millis in progress.durationMs.items()]
    for state in progress.stateOperators:
        found += [
            (f"state:{state.operatorName}", "rows", state.numRowsTotal), (f"state:{state.operatorName}", "updated", state.numRowsUpdated),
            (f"state:{state.operatorName}", "removed", state.numRowsRemoved), (f"state:{state.operatorName}", "memory-bytes", state.memoryUsedBytes),
        ]
    for observation, counts in progress.observedMetrics.items():
        found += [(observation, name, value) for name, value in counts.asDict().items() if isinstance(value, int)]
    return found


class ProgressLog(StreamingQueryListener):
    """Appends a few dozen numbers per micro-batch to Parquet files in ``folder``, for every query of the session it is added to.

    Listeners are called some time after a batch; ``wait`` returns when all of a stopped query is written. A batch may be
    reported twice, idle first or over a restart: ``read`` takes its last report. A failing write is kept for ``wait`` to raise;
    the query goes on."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._ended: dict[str, threading.Event] = {}
        self._failed: Exception | None = None
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [(str(progress.id), progress.batchId, progress.timestamp, *row) for row in _rows(progress)]
        try:
            self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self._folder)
        except Exception as problem:  # noqa: BLE001
            self._failed = problem

    def onQueryIdle(self, event) -> None:
        """Nothing was read, so there is nothing to write."""

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of query {query.runId} was not reported within {seconds} seconds")
        if self._failed is not None:
            raise self._failed


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (query, batch, part, name, value), the last report of each batch. A name that the last report lacks is gone with its report."""
    rows = spark.read.schema(SCHEMA).parquet(folder)
    last = rows.groupBy("query", "batch").agg(F.max("reported").alias("reported"))
    return rows.join(last, ["query", "batch", "reported"]).select("query", "batch", "part", "name", "value").distinct()


def totals(progress: DataFrame) -> DataFrame:
    """Sums over all batches of the counts that were observed or read; times are sums as well, state is no sum and is left out."""
    return progress.where(~F.col("part").startswith("state:")).groupBy("part", "name").agg(F.sum("value").alias("n"))
