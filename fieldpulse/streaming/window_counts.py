"""Open windows as exact distributions: how often each value occurs, per window, in runs of micro-batches (see ``runs``).

Counts can be added up, so the metrics of a window follow from its runs without the readings. A batch writes the counts of its own rows and reads those
of the windows it touched. Merging runs adds the counts up and leaves out windows that have ended, which bounds what is kept by the windows
that are still open.

A window has ended when the arrival clock is past its end, the grace period and ``horizon``. The clock is the largest of the batches' *median* arrival
times, so that no single row with a time far ahead or behind can end a window or keep one. Should a row still come for a window
that has ended, it is answered from the readings, so ending a window never changes a result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldpulse.functions.times import EPOCH, micros_between, utc_literal
from fieldpulse.operators.dedup import MAX_BROADCAST_BYTES, few_bytes
from fieldpulse.operators.quantile import group_stats
from fieldpulse.operators.skew import BATCH_ROWS, HotGroups, spread_join, tasks_for
from fieldpulse.operators.windows import DEFAULT_POLICY, WINDOW_KEYS, WindowPolicy
from fieldpulse.streaming.runs import Runs, as_note, from_note

_COUNTS = "device_id string, metric_type string, window_start timestamp_ntz, value double, n long, window_date date"


def _ends() -> list[Column]:
    return [F.min("window_start").alias("first"), F.max("window_start").alias("last")]


@dataclass(frozen=True)
class WindowCounts:
    spark: SparkSession
    root: str
    policy: WindowPolicy = DEFAULT_POLICY
    horizon: timedelta = timedelta(hours=1)
    fanout: int = 8

    @property
    def runs(self) -> Runs:
        return Runs(self.spark, self.root, self.fanout)

    def add(self, counted: DataFrame, batch_id: int) -> Row | None:
        """Counts the rows of a batch that count in their window: ``counted(device_id, metric_type, window_start, value, ingested_at)``. Returns the
        first and last window and the number of rows; None if there are none."""
        arrival = F.percentile_approx(micros_between(utc_literal(EPOCH), F.col("ingested_at")), 0.5)
        seen = counted.agg(arrival.alias("clock"), *_ends(), F.count(F.lit(1)).alias("rows")).first()
        if seen["clock"] is None:
            return None
        counts = counted.groupBy(*WINDOW_KEYS, "value").agg(F.count(F.lit(1)).alias("n"))
        self._write(counts, 0, batch_id, batch_id, EPOCH + timedelta(microseconds=seen["clock"]), seen)
        return seen

    def build(self, counted: DataFrame) -> None:
        """Counts all rows of a store filled without this table, as one run that covers all batches up to its last one."""
        seen = counted.agg(F.max("batch_id").alias("batch"), F.min("ingested_at").alias("at"), *_ends(), F.count(F.lit(1)).alias("rows")).first()
        if seen["batch"] is not None:
            counts = counted.groupBy(*WINDOW_KEYS, "value").agg(F.count(F.lit(1)).alias("n"))
            self._write(counts, 1, -1, seen["batch"], seen["at"], seen)

    def merge(self, before: int) -> None:
        """Merges levels that are full of batches before ``before``, without the windows that have ended."""
        self.runs.delete_covered()
        for level, full in self.runs.full_levels(before):
            summed = self._read([run.name for run in full]).where(~self._ended()).groupBy(*WINDOW_KEYS, "value").agg(F.sum("n").alias("n"))
            ends = [from_note(run.about[name]) for run in full for name in ("first", "last")]
            self._write(summed, level + 1, min(run.first_batch for run in full), max(run.last_batch for run in full),
                        max(from_note(run.about["clock"]) for run in full),
                        {"first": min(ends), "last": max(ends), "rows": sum(run.about["rows"] for run in full)})

    def _write(self, counts: DataFrame, level: int, first: int, last: int, clock: datetime, seen: Row | dict) -> None:
        dated = counts.withColumn("window_date", F.to_date("window_start")).hint("rebalance", "window_date")
        (dated.sortWithinPartitions("window_date", *WINDOW_KEYS[::-1]).write.mode("overwrite").partitionBy("window_date")
         .parquet(self.runs.folder(Runs.name(level, first, last), "counts")))
        self.runs.commit(level, first, last, {
            "clock": as_note(clock), "first": as_note(seen["first"]), "last": as_note(seen["last"]), "rows": seen["rows"]})

    def _read(self, names: list[str]) -> DataFrame:
        return self.runs.read(_COUNTS, [self.runs.folder(name, "counts") for name in names]).drop("run", "part")

    def clock(self, before: int | None = None) -> datetime | None:
        """The arrival clock, or that before a batch."""
        return max((from_note(run.about["clock"]) for run in self.runs.live(before)), default=None)

    def _ended(self, before: int | None = None) -> Column:
        end = self.policy.end(F.col("window_start")) + F.lit(self.policy.grace) + F.lit(self.horizon)
        clock = self.clock(before)
        return F.lit(False) if clock is None else end < utc_literal(clock)

    def held(self) -> DataFrame:
        """What the runs hold: a row per window, value and run."""
        live = [run.name for run in self.runs.live()]
        return self._read(live) if live else self.spark.createDataFrame([], _COUNTS)

    def touched(self, windows: DataFrame, batch_id: int, readings: DataFrame | None = None, hot: HotGroups = HotGroups(),
                few: bool = False, seen: Row | None = None) -> DataFrame:
        """Metrics of the distinct ``windows(device_id, metric_type, window_start)`` of a batch over all their rows so far.

        They are all windows of the batch, so its own counts need no join with them; a window without a device or metric has no metrics. Runs and days
        without one of the windows are not read. Windows that had ended before the batch are answered from ``readings``, the stored rows that count,
        with their window; without ``readings`` they are left out. ``few`` says that the windows can be broadcast, and ``seen`` is what ``add``
        returned for the batch.
        """
        over, clock = self._ended(batch_id), self.clock(batch_id)
        if seen is not None and (clock is None or seen["first"] + (self.policy.close_after or self.policy.bin) + self.policy.grace + self.horizon >= clock):
            span = {"first": seen["first"], "last": seen["last"], "first_ended": None}
        else:
            span = windows.agg(*_ends(), F.min(F.when(over, F.col("window_start"))).alias("first_ended"),
                               F.max(F.when(over, F.col("window_start"))).alias("last_ended")).first()
        ended = windows.where(over)
        runs = [] if span["first"] is None else [run for run in self.runs.live() if from_note(run.about["first"]) <= span["last"] and span["first"] <= from_note(run.about["last"])]
        own = [run.name for run in runs if (run.level, run.first_batch) == (0, batch_id)]
        others = [run for run in runs if run.name not in own]
        counts = self._read(own).where(~over).na.drop(subset=list(WINDOW_KEYS)) if own else self.spark.createDataFrame([], _COUNTS)
        if others:
            first = max(span["first"], min(from_note(run.about["first"]) for run in others))
            last = min(span["last"], max(from_note(run.about["last"]) for run in others))
            near = F.col("window_start").between(utc_literal(first), utc_literal(last))
            earlier = self._read([run.name for run in others]).where(F.col("window_date").between(first.date(), last.date()) & near)
            counts = counts.unionByName(_of(earlier, windows.where(~over & near), hot, few))
        # Runs of few rows in all have no hot group, so there is no need to look for one.
        held = sum(run.about["rows"] for run in runs)
        metrics = group_stats(counts, WINDOW_KEYS, hot=None if held <= hot.min_rows else hot, weight="n", tasks=tasks_for(self.spark, held, BATCH_ROWS))
        if readings is None or span["first_ended"] is None:
            return metrics
        first, end = span["first_ended"], span["last_ended"] + self.policy.bin
        inside = (F.col("event_date").between(first.date(), end.date())
                  & (F.col("recorded_at") >= utc_literal(first)) & (F.col("recorded_at") < utc_literal(end)))
        return metrics.unionByName(group_stats(_of(readings.where(inside), ended, hot, few), WINDOW_KEYS, hot=hot))


def _of(rows: DataFrame, windows: DataFrame, hot: HotGroups, few: bool) -> DataFrame:
    """Rows of the given windows; few windows are broadcast, so that the rows are not shuffled for it."""
    if few or few_bytes(windows, MAX_BROADCAST_BYTES):
        return rows.join(F.broadcast(windows), list(WINDOW_KEYS), "left_semi")
    return spread_join(rows, windows, WINDOW_KEYS, "value", "left_semi", hot)
