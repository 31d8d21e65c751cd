"""Operators that keep state inside the stream, for jobs without the ingest store."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.operators.dedup import ARRIVAL, KEY, content
from fieldpulse.operators.windows import (
    DEFAULT_POLICY, WINDOW_KEYS, WindowPolicy, drop_too_late, late_counters, lateness_class,
)
from fieldpulse.streaming.window_counts import WindowCounts


def new_keys(deliveries: DataFrame, key: str = KEY) -> DataFrame:
    """Each key once, in the micro-batch that first holds it. The state is the keys alone and needs no clock."""
    return deliveries.select(key).dropDuplicates([key])


def with_new_keys(deliveries: DataFrame, eligible: Column | None = None, key: str = KEY) -> DataFrame:
    """All deliveries (``_new`` is false) and a row for each new key of the eligible ones (``_new`` is true, no other columns)."""
    fresh = new_keys(deliveries if eligible is None else deliveries.where(eligible), key)
    return deliveries.withColumn("_new", F.lit(False)).unionByName(
        fresh.withColumn("_new", F.lit(True)), allowMissingColumns=True)


def dedup_stream(deliveries: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, key: str = KEY,
                 order: Sequence[str] = ARRIVAL, **trigger) -> StreamingQuery:
    """Starts a stream that hands the first delivery of each key, for all time, to ``write(rows, batch_id)``.

    The state holds the keys and nothing else, and a micro-batch costs work for its own rows only. A batch that is run
    again after a failure gives the same rows under the same id.
    """
    def first_rows(rows: DataFrame, batch_id: int) -> None:
        rest = [name for name in deliveries.columns if name != key]
        place = F.when(~F.col("_new"), F.struct(*order, content(deliveries)))
        # One aggregate reads the batch once; the bare rows of new keys have no place in the order.
        firsts = rows.groupBy(key).agg(F.min_by(F.struct(*rest), place).alias("_first"), F.max("_new").alias("_fresh"))
        write(firsts.where("_fresh").select(key, "_first.*").select(*deliveries.columns), batch_id)

    return (with_new_keys(deliveries, key=key).writeStream.outputMode("append").foreachBatch(first_rows)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def dedup_stream_within(deliveries: DataFrame, horizon: str, key: str = KEY) -> DataFrame:
    """One delivery per key, if copies arrive within ``horizon`` of each other; the state is bounded.

    The watermark is on arrival time and only limits the state. Among copies in one micro-batch it is not
    defined which one stays.
    """
    arrival = deliveries.withColumn("_arrival", F.col("ingested_at").cast("timestamp"))
    return arrival.withWatermark("_arrival", horizon).dropDuplicatesWithinWatermark([key]).drop("_arrival")


def window_metrics_stream(readings: DataFrame, counts: WindowCounts, write: Callable[[DataFrame, int], None], checkpoint: str,
                          **trigger) -> StreamingQuery:
    """Starts a stream over deduplicated readings that hands the metrics of the windows each batch touched to ``write(metrics, batch_id)``.

    Windows end, so what is kept has a bound: the counts of the windows of about the last ``counts.horizon``. The metrics of a window that has ended
    stand; a reading of it that arrived within its grace period, but is read so much later than its neighbours, is left out here. The ingest
    stream, which has the readings, counts it.
    """
    def run(rows: DataFrame, batch_id: int) -> None:
        counted = drop_too_late(rows, counts.policy).persist()
        try:
            counts.add(counted, batch_id)
            write(counts.touched(counted.select(*WINDOW_KEYS).distinct(), batch_id), batch_id)
        finally:
            counted.unpersist()
        counts.merge(batch_id)

    return (readings.writeStream.outputMode("append").foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def observe_late(readings: DataFrame, name: str = "late",
                 policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds the late counters to the progress events of a deduplicated stream."""
    return lateness_class(readings, policy).observe(name, *late_counters())
