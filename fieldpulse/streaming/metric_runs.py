"""Stored window metrics, clustered for point reads.

Every batch leaves a run (see ``runs``) of the windows it touched, ranged over files by window, device and metric and sorted within them; a small table
beside them says which keys each file holds. A point read looks into those tables and opens the files that may hold its window, one per run. Merging keeps
the latest row of each window, so the files to open grow with the logarithm of the number of batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.functions.times import utc_literal
from fieldpulse.operators.windows import WINDOW_KEYS
from fieldpulse.schemas import WINDOW_METRICS
from fieldpulse.session import cached
from fieldpulse.streaming.runs import Runs, as_note

ORDER = ("window_start", "device_id", "metric_type")
_METRICS = "device_id string, metric_type string, window_start timestamp_ntz, average double, p95 double, count long, batch_id long"
_FILES = "file string, first_window timestamp_ntz, first_device string, last_window timestamp_ntz, last_device string"


@dataclass(frozen=True)
class MetricRuns:
    spark: SparkSession
    root: str
    file_rows: int = 1_000_000
    fanout: int = 8

    @property
    def runs(self) -> Runs:
        return Runs(self.spark, self.root, self.fanout)

    def add(self, metrics: DataFrame, batch_id: int) -> None:
        self._write(metrics.select(*WINDOW_METRICS.names, F.lit(batch_id).cast("long").alias("batch_id")), 0, batch_id, batch_id)

    def merge(self, before: int) -> None:
        """Merges levels that are full of batches before ``before``; of each window the latest row stays."""
        self.runs.delete_covered()
        for level, full in self.runs.full_levels(before):
            self._write(_latest(self._read([run.name for run in full])), level + 1, min(run.first_batch for run in full), max(run.last_batch for run in full))

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        runs, name = self.runs, Runs.name(level, first, last)
        key = F.struct("window_start", "device_id")
        low, high = F.min(key).alias("low"), F.max(key).alias("high")
        rows = cached(rows)
        try:
            seen = rows.agg(F.count(F.lit(1)).alias("rows"), low, high).first()
            if not seen["rows"]:
                return
            files = -(-seen["rows"] // self.file_rows)
            ranged = rows.repartitionByRange(files, *ORDER) if files > 1 else rows.coalesce(1)
            ranged.sortWithinPartitions(*ORDER).write.mode("overwrite").parquet(runs.folder(name, "metrics"))
        finally:
            rows.unpersist()
        if files > 1:  # a single file has the keys of its run
            held = self._read([name]).groupBy(F.col("_metadata.file_path").alias("file")).agg(low, high)
            held.select("file", F.col("low.window_start").alias("first_window"), F.col("low.device_id").alias("first_device"),
                        F.col("high.window_start").alias("last_window"), F.col("high.device_id").alias("last_device")).coalesce(1).write.mode(
                "overwrite").parquet(runs.folder(name, "files"))
        runs.commit(level, first, last, {
            "files": files, "first": [as_note(seen["low"][0]), seen["low"][1]], "last": [as_note(seen["high"][0]), seen["high"][1]]})

    def _read(self, names: list[str]) -> DataFrame:
        return self.runs.read(_METRICS, [self.runs.folder(name, "metrics") for name in names])

    def latest(self) -> DataFrame:
        """The latest metrics of each window."""
        live = [run.name for run in self.runs.live()]
        return _latest(self._read(live) if live else self._none()).drop("batch_id")

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], _METRICS)

    def at(self, window_start: datetime, device_id: str | None = None, metric_type: str | None = None) -> DataFrame:
        """The latest metrics of one window, of one device or metric if given; reads the files that may hold them."""
        start = utc_literal(window_start)
        low, high = [as_note(window_start), device_id or ""], [as_note(window_start), device_id or chr(0x10FFFF)]
        live = [run for run in self.runs.live() if run.about["first"] <= high and low <= run.about["last"]]
        files = [self.runs.folder(run.name, "metrics") for run in live if run.about["files"] == 1]
        many = [self.runs.folder(run.name, "files") for run in live if run.about["files"] > 1]
        if many:
            files += [row.file for row in self.runs.read(_FILES, many).where(_may_hold(start, device_id)).select("file").collect()]
        rows = self.spark.read.schema(_METRICS).parquet(*files) if files else self._none()
        rows = rows.where(F.col("window_start") == start)
        for name, wanted in (("device_id", device_id), ("metric_type", metric_type)):
            rows = rows if wanted is None else rows.where(F.col(name) == wanted)
        return _latest(rows).drop("batch_id")


def _may_hold(start: Column, device_id: str | None) -> Column:
    """Whether a file's range of (window, device) has the wanted ones."""
    if device_id is None:
        return (F.col("first_window") <= start) & (F.col("last_window") >= start)
    after = (F.col("first_window") < start) | ((F.col("first_window") == start) & (F.col("first_device") <= device_id))
    before = (F.col("last_window") > start) | ((F.col("last_window") == start) & (F.col("last_device") >= device_id))
    return after & before


def _latest(rows: DataFrame) -> DataFrame:
    latest = F.max_by(F.struct("average", "p95", "count"), "batch_id").alias("latest")
    return rows.groupBy(*WINDOW_KEYS).agg(latest, F.max("batch_id").alias("batch_id")).select(*WINDOW_KEYS, "latest.*", "batch_id")
