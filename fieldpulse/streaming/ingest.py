"""The ingest stream: deliveries in, stored readings, rejects, outcome counts, late rows, answers and window metrics out.

``start_ingest`` runs the batch operators on each micro-batch and then writes. The device table is loaded per
batch, so newly registered devices count. Dedup asks the store's key index, which reads a few files per micro-batch however large the store
is; it also says where the stored reading of a duplicate lies, so that every duplicate is answered with it. Window metrics come from the
counts of open windows that the store keeps, not from the readings.

``start_stateful_ingest`` remembers the keys in the stream's state instead. Its device table is the one current at the start; a batch that a
dead run left open is first run again with the table of that run. It writes no answers.

Either way the first delivery of a key wins for all time, and only the windows that a batch touched are
computed again; the stateful stream reads their stored readings for that. Fill a store in one of the two ways only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.functions.times import utc_literal
from fieldpulse.operators.dedup import KEY, MAX_BROADCAST_BYTES, answer_duplicates, few_bytes
from fieldpulse.operators.outcome import (
    DROPPED_LATE, DUPLICATE, check_deliveries, counted_rows, label_outcomes, outcome_counts, rejected_rows, stored_rows,
)
from fieldpulse.operators.quantile import group_stats
from fieldpulse.operators.skew import HotGroups
from fieldpulse.operators.windows import (
    DEFAULT_POLICY, WINDOW_KEYS, WindowPolicy, drop_too_late, rows_within,
)
from fieldpulse.schemas import DEVICE_CHANGE, READING
from fieldpulse.session import cached
from fieldpulse.streaming.progress import last_commit
from fieldpulse.streaming.stateful import with_new_keys
from fieldpulse.streaming.store import Store

# Join keys per device in the stateful stream, if its device ids are too large to broadcast.
DEVICE_SALTS = 16


def ingest_batch(deliveries: DataFrame, batch_id: int, store: Store,
                 policy: WindowPolicy = DEFAULT_POLICY, hot: HotGroups = HotGroups(), devices: DataFrame | None = None) -> None:
    """One batch, start to end. Running it again with the same id and rows changes nothing.

    ``deliveries`` holds the request columns and ``decode_error``. ``devices`` is the store's table unless given.
    """
    devices = store.devices(store.devices_version(batch_id)) if devices is None else devices
    index = store.key_index
    if not index.runs.live() and store.has_readings():  # a store filled before it had an index
        earlier = store.readings().where(F.col("batch_id") != batch_id)
        index.build(earlier)
        store.window_counts(policy).build(drop_too_late(earlier, policy))
    checked = cached(check_deliveries(deliveries, devices, message=False))
    try:
        # Staged, as the labels and the answers ask for it several times.
        seen = store.staged(index.seen(checked.where("storable"), batch_id), batch_id, "staging_seen")
        _write_labelled(label_outcomes(checked, seen.select(KEY), policy, hot), batch_id, store, policy, hot, seen)
    finally:
        checked.unpersist()
    index.merge(batch_id)
    store.window_counts(policy).merge(batch_id)


def _write_labelled(labelled: DataFrame, batch_id: int, store: Store, policy: WindowPolicy,
                    hot: HotGroups, seen: DataFrame | None = None) -> None:
    """Writes all tables of a batch. ``seen`` holds the keys stored before, with the place of their reading, if the key index is in use."""
    # Labels serve several writes; blocks of a lost executor are computed again. Without an index the readings come
    # last, as writing to a table drops cached rows that were derived from it.
    labelled = cached(labelled)
    try:
        store.write_outcomes(outcome_counts(labelled), batch_id)  # reads all rows, so the others find them cached
        stored = stored_rows(labelled)
        writes = [lambda: store.write_rejects(rejected_rows(labelled), batch_id),
                  lambda: store.write_late(labelled.where(F.col("outcome") == DROPPED_LATE), batch_id)]
        if seen is not None:
            writes += [lambda: store.write_answers(_answers(labelled, seen, store, hot), batch_id),
                       lambda: store.key_index.add(stored.select(KEY, F.to_date("recorded_at").alias("event_date")), batch_id),
                       lambda: _write_counted(labelled, batch_id, store, policy, hot),
                       lambda: store.write_readings(stored, batch_id)]
        _side_by_side(writes)
        if seen is None:
            store.write_readings(stored, batch_id)
            touched = touched_metrics(store, batch_id, policy, hot)
            if touched is not None:
                store.write_metrics(touched, batch_id)
    finally:
        labelled.unpersist()
    store.metric_runs.merge(batch_id)


def _write_counted(labelled: DataFrame, batch_id: int, store: Store, policy: WindowPolicy, hot: HotGroups) -> None:
    """The counts of the batch and the metrics of its windows. Windows that had ended are answered from the readings of earlier batches and this one."""
    counts, counted = store.window_counts(policy), counted_rows(labelled)
    seen = counts.add(counted, batch_id)
    if seen:
        earlier = drop_too_late(store.readings().where(F.col("batch_id") != batch_id), policy)
        own = counted.withColumns({"event_date": F.to_date("recorded_at"), "batch_id": F.lit(batch_id).cast("long")}).select(*earlier.columns)
        windows = counted.select(*WINDOW_KEYS).distinct()
        # Ids of stored rows have a bounded length, so few rows have few bytes.
        store.write_metrics(counts.touched(windows, batch_id, earlier.unionByName(own), hot, seen["rows"] <= MAX_BROADCAST_BYTES // 512, seen), batch_id)


def _answers(labelled: DataFrame, seen: DataFrame, store: Store, hot: HotGroups) -> DataFrame:
    """The batch's duplicates with the reading stored for their key, by this batch or an earlier one."""
    earlier = store.readings_at(seen).select(*READING.names).join(seen.select(KEY), KEY, "left_semi")
    own, duplicates = stored_rows(labelled).select(*READING.names), labelled.where(F.col("outcome") == DUPLICATE)
    asked = duplicates.select(KEY).distinct()
    if few_bytes(asked, MAX_BROADCAST_BYTES):  # then the readings without a duplicate are not shuffled
        own = own.join(F.broadcast(asked), KEY, "left_semi")
    return answer_duplicates(duplicates, own.unionByName(earlier), hot=hot)


def _side_by_side(writes: list[Callable[[], None]]) -> None:
    """Runs the writes of a batch at the same time, as each is a few small jobs; the first failure is raised when all have ended."""
    failures: list[Exception] = []

    def run(write: Callable[[], None]) -> None:
        try:
            write()
        except Exception as failure:  # raised below, in the batch's own thread
            failures.append(failure)
    threads = [InheritableThread(target=run, args=(write,)) for write in writes]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failures:
        raise failures[0]


def touched_metrics(store: Store, batch_id: int, policy: WindowPolicy = DEFAULT_POLICY,
                    hot: HotGroups = HotGroups()) -> DataFrame | None:
    """Metrics of the windows a stored batch added to, over all their readings; None if it added to none.

    The grace rule keeps such windows recent, so the time bounds leave few files to read.
    """
    readings = store.readings()
    added = drop_too_late(readings.where(F.col("batch_id") == batch_id), policy)
    span = added.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
    if span["first"] is None:
        return None
    end = span["last"] + policy.bin
    inside = (F.col("event_date").between(span["first"].date(), end.date())
              & (F.col("recorded_at") >= utc_literal(span["first"]))
              & (F.col("recorded_at") < utc_literal(end)))
    counted = drop_too_late(readings.where(inside & (F.col("batch_id") != batch_id)), policy)
    before = counted.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
    if before["first"] is not None:  # of the earlier readings those in windows of the batch
        near = F.col("window_start").between(utc_literal(before["first"]), utc_literal(before["last"]))
        added = added.unionByName(rows_within(counted, added.where(near), WINDOW_KEYS, hot))
    return group_stats(added.na.drop(subset=list(WINDOW_KEYS)), WINDOW_KEYS, hot=hot)


def start_ingest(deliveries: DataFrame, store: Store, checkpoint: str,
                 policy: WindowPolicy = DEFAULT_POLICY, hot: HotGroups = HotGroups(),
                 **trigger) -> StreamingQuery:
    """Starts the stream. Offsets are committed after a batch is stored, so nothing is lost on a crash."""
    return (deliveries.writeStream
            .foreachBatch(lambda rows, batch_id: ingest_batch(rows, batch_id, store, policy, hot))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def start_stateful_ingest(deliveries: DataFrame, store: Store, checkpoint: str,
                          policy: WindowPolicy = DEFAULT_POLICY, hot: HotGroups = HotGroups(),
                          max_broadcast: int = MAX_BROADCAST_BYTES, **trigger) -> StreamingQuery:
    """Starts the stream with the seen keys in its state. Every delivery of a micro-batch and the keys that are new
    in it reach one sink, which labels and stores them like ``start_ingest``.

    Use a store that was filled this way from its first batch, as the state holds the keys. A reading of a
    device that registers later is rejected under the table that its batch noted, and leaves its key free. The device ids
    are broadcast while they take at most ``max_broadcast`` bytes; beyond that the join with them is salted.
    """
    spark = deliveries.sparkSession
    version = store.version_after(last_commit(spark, checkpoint))
    ids, salts = store.devices(version).select("id"), DEVICE_SALTS
    if few_bytes(ids, max_broadcast):
        ids, salts = F.broadcast(ids), 1
    both = with_new_keys(check_deliveries(deliveries, ids, salts, message=False), F.col("storable"))

    def store_batch(rows: DataFrame, batch_id: int) -> None:
        store.devices_version(batch_id, version)
        # Staged, as AQE, which evens out the files, is off within a plan that has state.
        staged = store.staged(rows, batch_id)
        batch = staged.where("not _new").drop("_new")
        seen = batch.where("storable").select(KEY).distinct().join(staged.where("_new").select(KEY), KEY, "left_anti")
        _write_labelled(label_outcomes(batch, seen, policy, hot), batch_id, store, policy, hot)

    return (both.writeStream.outputMode("append").foreachBatch(store_batch)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def start_live_ingest(deliveries: DataFrame, changes: DataFrame, store: Store, checkpoint: str,
                      policy: WindowPolicy = DEFAULT_POLICY, hot: HotGroups = HotGroups(), **trigger) -> StreamingQuery:
    """Starts one stream over deliveries and device changes (schemas.DEVICE_CHANGE), both read by the same micro-batches.

    A micro-batch applies its changes first and then judges each reading by its device at the time of arrival, so a device that
    registers while the stream runs is known from that time on, whichever of the two rows was read first within the batch. A change that is read by
    a later batch than a reading does not change what became of the reading.
    """
    both = deliveries.select(F.struct(*deliveries.columns).alias("delivery")).unionByName(
        changes.select(F.struct(*DEVICE_CHANGE.names).alias("change")), allowMissingColumns=True)

    def run(rows: DataFrame, batch_id: int) -> None:
        staged = store.staged(rows, batch_id)
        known = store.apply_changes(staged.where("change is not null").select("change.*"), batch_id)
        ingest_batch(staged.where("delivery is not null").select("delivery.*"), batch_id, store, policy, hot, known)

    return (both.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
