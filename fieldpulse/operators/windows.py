"""Tumbling event-time windows with a grace period measured against arrival time.

Lateness is a rule per row: window end against the row's own arrival. A watermark is a different rule, as
it moves with other rows, and is never used to decide it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.times import bin_start, floor_to, utc_literal
from fieldpulse.operators.dedup import few_bytes
from fieldpulse.operators.quantile import group_stats
from fieldpulse.operators.skew import HotGroups, spread_join

# Fixed values.
ON_TIME = "ON_TIME"
LATE_ACCEPTED = "LATE_ACCEPTED"
LATE_DROPPED = "LATE_DROPPED"

WINDOW_KEYS = ("device_id", "metric_type", "window_start")

# Text of the windows that may be broadcast.
MAX_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class WindowPolicy:
    """``bin`` cuts event time; a window closes ``close_after`` past its start (``bin`` if not given)."""

    bin: timedelta = timedelta(minutes=1)
    close_after: timedelta | None = None
    grace: timedelta = timedelta(seconds=10)

    def start(self, recorded_at: Column) -> Column:
        return bin_start(recorded_at, self.bin)

    def end(self, window_start: Column) -> Column:
        return window_start + F.lit(self.close_after or self.bin)


DEFAULT_POLICY = WindowPolicy()


def window_key(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    return readings.withColumn("window_start", policy.start(F.col("recorded_at")))


def lateness_class(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds the window, its end and the lateness class; both bounds belong to the accepting side."""
    arrived, end = F.col("ingested_at"), F.col("window_end")
    return (window_key(readings, policy)
            .withColumn("window_end", policy.end(F.col("window_start")))
            .withColumn("lateness", F.when(arrived <= end, ON_TIME)
                        .when(arrived <= end + F.lit(policy.grace), LATE_ACCEPTED)
                        .otherwise(LATE_DROPPED)))


def late_by(classified: DataFrame) -> DataFrame:
    """How long after its window's end a late row arrived; null for rows in time."""
    gap = F.col("ingested_at") - F.col("window_end")
    return classified.withColumn("late_by", F.when(F.col("lateness") != ON_TIME, gap))


def drop_too_late(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    """Rows that count in their window. Rows left out here stay in the reading table."""
    closes = policy.end(F.col("window_start")) + F.lit(policy.grace)
    return window_key(readings, policy).where(F.col("ingested_at") <= closes)


def late_dropped_rows(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    dropped = late_by(lateness_class(readings, policy)).where(F.col("lateness") == LATE_DROPPED)
    return dropped.select("idempotency_key", "device_id", "metric_type", "window_start", "window_end",
                          "late_by")


def late_counts(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    return lateness_class(readings, policy).agg(*late_counters())


def late_counters() -> list[Column]:
    """The two counters, for ``agg`` in batch or ``observe`` on a deduplicated stream."""
    return [
        F.count_if(F.col("lateness") == LATE_ACCEPTED).alias("late_accepted"),
        F.count_if(F.col("lateness") == LATE_DROPPED).alias("late_dropped"),
    ]


def window_avg(accepted: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    return accepted.groupBy(*keys).agg(F.avg("value").alias("average"))


def window_count(accepted: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    return accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def window_p95(accepted: DataFrame, keys: Sequence[str] = WINDOW_KEYS,
               hot: HotGroups = HotGroups()) -> DataFrame:
    return group_stats(accepted, keys, hot=hot).select(*keys, "p95")


def window_metrics(readings: DataFrame, policy: WindowPolicy = DEFAULT_POLICY,
                   keys: Sequence[str] = WINDOW_KEYS, hot: HotGroups = HotGroups(),
                   only: DataFrame | None = None) -> DataFrame:
    """Average, p95 and count per window of the stored readings that count, or just of windows in ``only``."""
    accepted = drop_too_late(readings, policy)
    if only is not None:
        accepted = rows_within(accepted, only, keys, hot)
    return group_stats(accepted, keys, hot=hot)


def rows_within(rows: DataFrame, only: DataFrame, keys: Sequence[str], hot: HotGroups) -> DataFrame:
    """Rows of the given windows; few windows are broadcast, so that the rows are not shuffled for it."""
    only = only.select(*keys).distinct()
    if few_bytes(only, MAX_BROADCAST_BYTES):
        return rows.join(F.broadcast(only), list(keys), "left_semi")
    return spread_join(rows, only, keys, "idempotency_key", "left_semi", hot)


def current_window(readings: DataFrame, as_of: datetime, policy: WindowPolicy = DEFAULT_POLICY,
                   hot: HotGroups = HotGroups()) -> DataFrame:
    """Metrics of the window that holds ``as_of`` (UTC); a group without data has no row.

    The bounds on ``recorded_at`` reach the scan, so only that window's row groups are read.
    """
    start = floor_to(as_of, policy.bin)
    inside = readings.where((F.col("recorded_at") >= utc_literal(start))
                            & (F.col("recorded_at") < utc_literal(start + policy.bin)))
    return window_metrics(inside, policy, hot=hot)
