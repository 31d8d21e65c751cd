"""Readings of a stream's own progress events, while it runs and as a table."""

from __future__ import annotations

import json
import threading
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def drain_rate(query: StreamingQuery) -> float | None:
    """Rows per second over the recent micro-batches that had rows; None if none had."""
    busy = [event for event in query.recentProgress if event["numInputRows"]]
    if not busy:
        return None
    seconds = sum(event["durationMs"]["triggerExecution"] for event in busy) / 1000
    return sum(event["numInputRows"] for event in busy) / seconds


def backlog(query: StreamingQuery) -> dict[str, dict]:
    """Per source, how far the last micro-batch read, and what the source reports as outstanding.

    Kafka reports the offsets behind the latest; file sources report no such metrics.
    """
    last = query.lastProgress
    if last is None:
        return {}
    return {
        source["description"]: {"end_offset": source["endOffset"], "outstanding": source["metrics"]}
        for source in last["sources"]
    }


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that the stream with this checkpoint has finished; -1 if none."""
    try:
        commits = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoint}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    number = F.element_at(F.split("path", "/"), -1).cast("long")
    return commits.select("path").agg(F.coalesce(F.max(number), F.lit(-1))).first()[0]


_PROGRESS = ("query_id string, run_id string, name string, batch_id long, started_at timestamp_ntz, input_rows long, batch_ms long, "
             "rows_per_second double, backlog string")


class ProgressTable(StreamingQueryListener):
    """Appends the progress of streams to a table: rows, time, rate and backlog of every micro-batch that had rows.

    Add it with ``spark.streams.addListener``. The table outlives the streams; a batch that was run again after a failure has a row per run that
    finished it. ``backlog`` is what the sources report, as JSON by source. Events are kept until ``every`` of them are written
    together, or a stream ends.
    """

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = (), every: int = 1):
        self.spark, self.path, self.names, self.every = spark, path, names, every
        self._held: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        if not seen.numInputRows or (self.names and seen.name not in self.names):
            return
        took = seen.durationMs["triggerExecution"]
        backlog = {source.description: {"end_offset": source.endOffset, **{key: str(value) for key, value in (source.metrics or {}).items()}} for source in seen.sources}
        started = datetime.fromisoformat(seen.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
        with self._lock:
            self._held.append((str(seen.id), str(seen.runId), seen.name, seen.batchId, started, seen.numInputRows, took,
                               1000 * seen.numInputRows / took if took else None, json.dumps(backlog)))
        if len(self._held) >= self.every:
            self.write()

    def onQueryTerminated(self, event) -> None:
        self.write()
        with self._lock:
            self._ended.setdefault(str(event.runId), threading.Event()).set()

    def write(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
            if rows:
                self.spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Waits until the rows of a query that has ended are written, as events come on a thread of their own."""
        with self._lock:
            ended = self._ended.setdefault(str(query.runId), threading.Event())
        return ended.wait(seconds)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_PROGRESS).parquet(self.path)


def rates(progress: DataFrame) -> DataFrame:
    """Per stream: micro-batches, rows and rows per second over all of them."""
    return progress.groupBy("query_id").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("rows"),
        (F.sum("input_rows") * 1000 / F.sum("batch_ms")).alias("rows_per_second"))
