"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.functions.times import micros_between, utc_literal
from fieldpulse.operators import (
    decode, dedup, outcome, referential, registry, subscriptions, validate, views, windows,
)
from fieldpulse.operators.skew import HotGroups
from fieldpulse.operators.windows import WindowPolicy
from fieldpulse.schemas import DEVICE_CHANGE
from fieldpulse.session import scratch_dir
from fieldpulse.sources import messages as files
from fieldpulse.sources import testdata as td
from fieldpulse.streaming import stateful
from fieldpulse.streaming.ingest import ingest_batch, start_ingest, start_live_ingest, start_stateful_ingest
from fieldpulse.streaming.key_index import IndexShape, KeyIndex, dedup_against_index
from fieldpulse.streaming.progress import ProgressTable
from fieldpulse.streaming.store import Store
from fieldpulse.streaming.window_counts import WindowCounts

Query = Callable[[SparkSession, str], DataFrame]

DAY = WindowPolicy(bin=timedelta(days=1))
AS_OF = datetime(2024, 1, 15, 12, 30, 30)
BATCH_TS = datetime(2024, 2, 2)
READING = ("device_id", "metric_type", "value", "recorded_at", "ingested_at", "idempotency_key",
           "delivery_seq")
# Arrival times that cut the deliveries into micro-batches; the first and the last are open, and rows without one come first.
SLICES = (None, datetime(2024, 1, 11), datetime(2024, 1, 21), None)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _rounded(metrics: DataFrame) -> DataFrame:
    """Averages of doubles depend on the order of summation in their last bits."""
    return metrics.withColumn("average", F.round("average", 6))


def _plain(deliveries: DataFrame) -> DataFrame:
    """Direct requests as deliveries."""
    return deliveries.withColumn("decode_error", F.lit(False))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the reading table holds after all deliveries."""
    known = referential.known_device_readings(td.deliveries(spark, sf_dir), td.device_ids(spark, sf_dir))
    return dedup.dedup_first_wins(known)


def _deliver(rows: DataFrame, write: Callable[[DataFrame], None],
             start: Callable[[], Iterable[StreamingQuery]]) -> None:
    """Delivers rows in arrival order: each slice is written and then run to its end as one micro-batch."""
    for first, end in zip(SLICES, SLICES[1:]):
        arrived = F.col("ingested_at")
        since = arrived >= utc_literal(first) if first else F.lit(True)
        until = arrived < utc_literal(end) if end else F.lit(True)
        write(rows.where(since & until | arrived.isNull() if first is None else since & until))
        for query in start():
            query.awaitTermination()


def _run_stream(rows: DataFrame, begin: Callable[[DataFrame, Callable[[DataFrame, int], None], str], StreamingQuery],
                spark: SparkSession, purpose: str) -> DataFrame:
    """Streams rows through ``begin(source, sink, checkpoint)``; returns the emitted rows with their batch."""
    root = scratch_dir(spark, purpose)

    def sink(emitted: DataFrame, batch_id: int) -> None:
        (emitted.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/out"))

    def start() -> list[StreamingQuery]:
        source = files.reading_requests(spark, f"{root}/in", "parquet", streaming=True)
        return [begin(source, sink, f"{root}/checkpoint")]

    _deliver(rows, lambda part: part.write.mode("append").parquet(f"{root}/in"), start)
    return spark.read.parquet(f"{root}/out")


# -- sources and sinks -------------------------------------------------------------------------------

@_query
def reading_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "messages")
    td.stray_topics(spark, sf_dir).write.options(**files.JSON_TIMES).json(path)
    return files.reading_messages(spark, path).select("topic", "ingested_at", "delivery_seq")


@_query
def reading_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "requests")
    td.faulty_requests(spark, sf_dir).write.options(**files.JSON_TIMES).json(path)
    return files.reading_requests(spark, path)


@_query
def device_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "device-requests")
    td.device_requests(spark, sf_dir).write.options(**files.JSON_TIMES).json(path)
    return files.device_requests(spark, path)


@_query
def write_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_dir(spark, "store")).create()
    store.write_devices(td.devices(spark, sf_dir))
    for batch_id in (0, 0, 1):  # batch 0 is replayed, then all is delivered again
        ingest_batch(_plain(td.deliveries(spark, sf_dir)), batch_id, store)
    return store.readings().select(*READING)


@_query
def write_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_dir(spark, "store")).create()
    store.write_devices(td.devices(spark, sf_dir))
    store.write_devices(registry.patch_devices(td.device_patches(spark, sf_dir), store.devices(), BATCH_TS))
    return views.device_view(store.devices())


@_query
def merge_transports(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = td.deliveries(spark, sf_dir)
    over_topic = F.col("metric_type").isin("click", "view", "error")
    decoded = decode.payload_decode(td.as_messages(deliveries.where(over_topic)))
    return decode.merge_transports(decoded, deliveries.where(~over_topic))


# -- decode and projection ---------------------------------------------------------------------------

@_query
def topic_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.topic_match(td.stray_topics(spark, sf_dir)).select("topic", "delivery_seq")


@_query
def subscription_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscriptions.subscription_match(td.stray_topics(spark, sf_dir), td.subscriptions(spark, sf_dir)).select(
        "subscription", "topic", "delivery_seq")


@_query
def topic_device_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.stray_topics(spark, sf_dir).select(
        "topic", "delivery_seq", decode.topic_device_id(F.col("topic")).alias("device_id"))


@_query
def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.payload_decode(td.messages(spark, sf_dir)).drop("payload")


@_query
def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_rejects(td.messages(spark, sf_dir)).drop("payload")


@_query
def recorded_at_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.recorded_at_default(td.faulty_requests(spark, sf_dir)).select(
        "delivery_seq", "recorded_at", "ingested_at")


@_query
def ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka records as messages, stamped with the broker's time."""
    arrived = files.messages_from_kafka(td.kafka_records(spark, sf_dir)).drop("payload")
    return files.ingest_stamp(arrived.withColumnRenamed("ingested_at", "broker_time"), "broker_time").drop("broker_time")


@_query
def device_type_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = validate.device_type_known(F.col("device_type"))
    return td.device_requests(spark, sf_dir).select("seq", "device_type", known.alias("type_known"))


@_query
def location_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = views.location_pack(td.device_requests(spark, sf_dir))
    return packed.select("seq", F.to_json("location").alias("location"))


@_query
def location_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.location_flatten(td.devices(spark, sf_dir)).select("id", "latitude", "longitude")


@_query
def reading_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag_us = micros_between(F.col("recorded_at"), F.col("ingested_at"))
    return views.reading_view(td.readings(spark, sf_dir)).withColumn("lag_us", lag_us).drop("lag")


@_query
def device_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.device_view(td.devices(spark, sf_dir))


# -- validation --------------------------------------------------------------------------------------

@_query
def validate_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.validate_readings(td.faulty_requests(spark, sf_dir))
    return checked.select("delivery_seq", F.size("violations").cast("long").alias("violation_count"))


@_query
def validate_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.validate_devices(td.device_requests(spark, sf_dir))
    return checked.select("seq", F.size("violations").cast("long").alias("violation_count"))


@_query
def validate_device_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.patch_outcome(td.device_patches(spark, sf_dir), td.devices(spark, sf_dir)).select(
        "id", "seq", "error")


@_query
def violation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.validate_readings(td.faulty_requests(spark, sf_dir))
    return validate.violation_list(checked, "delivery_seq")


@_query
def device_violation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.validate_devices(td.device_requests(spark, sf_dir))
    return validate.violation_list(checked, "seq")


# -- referential checks ------------------------------------------------------------------------------

@_query
def known_device_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return referential.known_device_readings(
        td.deliveries(spark, sf_dir), td.device_ids(spark, sf_dir)).select(*READING)


@_query
def unknown_device_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return referential.unknown_device_readings(
        td.deliveries(spark, sf_dir), td.device_ids(spark, sf_dir)).select(*READING)


@_query
def resolve_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.resolve_duplicates(td.deliveries(spark, sf_dir), _stored(spark, sf_dir))


@_query
def reading_with_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = referential.reading_with_device(td.readings(spark, sf_dir), td.devices(spark, sf_dir))
    return joined.select("idempotency_key", "device_id", "device_name", "device_type", "site", "value")


# -- deduplication -----------------------------------------------------------------------------------

@_query
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_first_wins(td.deliveries(spark, sf_dir))


@_query
def dedup_against_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = td.deliveries(spark, sf_dir)
    stored = dedup.dedup_first_wins(
        deliveries.where(F.col("ingested_at") < utc_literal(datetime(2024, 1, 16))))
    batch = deliveries.where(F.col("ingested_at") >= utc_literal(datetime(2024, 1, 8)))
    return dedup.dedup_against_store(batch, stored)


@_query
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(
        td.deliveries(spark, sf_dir), stateful.dedup_stream, spark, "dedup-stream").select(*READING)


@_query
def key_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``dedup_against_store``, but the stored keys are asked for through an index that four batches filled."""
    deliveries, arrived = td.deliveries(spark, sf_dir), F.col("ingested_at")
    stored = dedup.dedup_first_wins(deliveries.where(arrived < utc_literal(datetime(2024, 1, 16))))
    index = KeyIndex(spark, scratch_dir(spark, "key-index"), IndexShape(slot_keys=256, bucket_slots=2, fanout=2))
    for number in range(4):
        part = stored.where(F.pmod(F.xxhash64("idempotency_key"), F.lit(4)) == number)
        index.add(part.select("idempotency_key", F.to_date("recorded_at").alias("event_date")), number)
        index.merge(number)
    return dedup_against_index(deliveries.where(arrived >= utc_literal(datetime(2024, 1, 8))), index)


@_query
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_count(referential.known_device_readings(
        td.deliveries(spark, sf_dir), td.device_ids(spark, sf_dir)))


# -- windows and lateness ----------------------------------------------------------------------------

@_query
def window_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_key(td.readings(spark, sf_dir)).select(
        "idempotency_key", "device_id", "metric_type", "window_start")


@_query
def lateness_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.lateness_class(td.readings(spark, sf_dir)).select(
        "idempotency_key", "window_start", "window_end", "lateness")


@_query
def late_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = windows.late_by(windows.lateness_class(td.readings(spark, sf_dir)))
    return late.where(F.col("late_by").isNotNull()).select("idempotency_key", _late_us())


@_query
def drop_too_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.drop_too_late(td.readings(spark, sf_dir)).select(*READING, "window_start")


@_query
def late_dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = windows.late_dropped_rows(td.readings(spark, sf_dir))
    return dropped.withColumn("late_us", _late_us()).drop("late_by")


def _late_us():
    """The interval in microseconds, as engines differ in how they show intervals."""
    return F.expr("CAST(extract(DAY FROM late_by) * 86400000000 + extract(HOUR FROM late_by) * 3600000000"
                  " + extract(MINUTE FROM late_by) * 60000000"
                  " + CAST(extract(SECOND FROM late_by) * 1000000 AS BIGINT) AS BIGINT)").alias("late_us")


@_query
def window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(windows.window_avg(windows.drop_too_late(td.readings(spark, sf_dir))))


@_query
def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_count(windows.drop_too_late(td.readings(spark, sf_dir)))


@_query
def window_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_p95(windows.drop_too_late(td.readings(spark, sf_dir), DAY))


@_query
def window_p95_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = windows.drop_too_late(td.readings(spark, sf_dir), DAY)
    return windows.window_p95(accepted, keys=("metric_type", "window_start"))


@_query
def window_p95_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result as above, with the path for groups that no single task should hold."""
    accepted = windows.drop_too_late(td.readings(spark, sf_dir), DAY)
    return windows.window_p95(accepted, keys=("metric_type", "window_start"), hot=HotGroups(min_rows=20))


@_query
def window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(windows.window_metrics(td.readings(spark, sf_dir)))


@_query
def window_metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(windows.window_metrics(td.readings(spark, sf_dir), DAY))


@_query
def window_metrics_close_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of one minute that close two minutes after their start."""
    policy = WindowPolicy(close_after=timedelta(minutes=2))
    return _rounded(windows.window_metrics(td.readings(spark, sf_dir), policy))


@_query
def current_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(windows.current_window(td.readings(spark, sf_dir), AS_OF, DAY))


@_query
def late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.late_counts(td.readings(spark, sf_dir))


@_query
def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last metrics of each window that a stream emitted, from counts of the windows that are open."""
    counts = WindowCounts(spark, scratch_dir(spark, "window-counts"), fanout=2)

    def begin(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
        return stateful.window_metrics_stream(source, counts, sink, checkpoint)

    emitted = _run_stream(td.readings(spark, sf_dir), begin, spark, "window-stream")
    last = emitted.groupBy("device_id", "metric_type", "window_start").agg(
        F.max_by(F.struct("average", "p95", "count"), "batch_id").alias("last"))
    return _rounded(last.select("device_id", "metric_type", "window_start", "last.*"))


# -- device registry ---------------------------------------------------------------------------------

def _registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that holds the devices with a gateway, before the others register."""
    return td.devices(spark, sf_dir).where(F.col("device_type") == "GATEWAY")


@_query
def register_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.device_view(registry.register_devices(
        td.device_requests(spark, sf_dir), _registered(spark, sf_dir), BATCH_TS))


@_query
def register_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.register_outcome(td.device_requests(spark, sf_dir), _registered(spark, sf_dir)).select(
        "id", "seq", "outcome")


@_query
def get_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = td.table(spark, sf_dir, "customer").select(F.concat(F.lit("dev-"), "c_custkey").alias("id"))
    return registry.get_devices(ids, td.devices(spark, sf_dir)).select(
        "id", "found", "device_name", "device_type", "site")


@_query
def list_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.device_view(registry.list_devices(td.devices(spark, sf_dir)))


@_query
def patch_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.device_view(registry.patch_devices(
        td.device_patches(spark, sf_dir), td.devices(spark, sf_dir), BATCH_TS))


@_query
def audit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times after a registration and then a patch batch."""
    registered = registry.register_devices(
        td.device_requests(spark, sf_dir), _registered(spark, sf_dir), datetime(2024, 1, 20))
    patched = registry.patch_devices(td.device_patches(spark, sf_dir), registered, BATCH_TS)
    return patched.select("id", "created_at", "updated_at")


@_query
def delete_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.device_view(registry.delete_devices(
        td.device_deletes(spark, sf_dir), td.devices(spark, sf_dir), td.readings(spark, sf_dir)))


@_query
def delete_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.delete_outcome(
        td.device_deletes(spark, sf_dir), td.devices(spark, sf_dir), td.readings(spark, sf_dir)
    ).select("id", "seq", "outcome")


@_query
def apply_device_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after a batch that mixes registrations, patches and deletions of the same devices."""
    return views.device_view(registry.apply_changes(
        td.device_changes(spark, sf_dir), td.devices(spark, sf_dir), td.some_readings(spark, sf_dir), BATCH_TS))


@_query
def device_change_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.change_outcome(
        td.device_changes(spark, sf_dir), td.devices(spark, sf_dir), td.some_readings(spark, sf_dir)).select("id", "seq", "kind", "outcome")


# -- outcome and progress ----------------------------------------------------------------------------

@_query
def ingest_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.ingest_outcome(_plain(td.deliveries(spark, sf_dir)), td.device_ids(spark, sf_dir)).select(
        "delivery_seq", "idempotency_key", "outcome")


@_query
def ingest_outcome_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.payload_decode(decode.topic_match(td.messages(spark, sf_dir)))
    return outcome.ingest_outcome(decoded, td.device_ids(spark, sf_dir)).select(
        "delivery_seq", "idempotency_key", "outcome")


@_query
def ingest_outcome_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.ingest_outcome(
        _plain(td.faulty_requests(spark, sf_dir)), td.device_ids(spark, sf_dir)).select(
        "delivery_seq", "recorded_at", "outcome")


@_query
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.outcome_counts(
        outcome.ingest_outcome(_plain(td.deliveries(spark, sf_dir)), td.device_ids(spark, sf_dir)))


@_query
def reading_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reading_counts(_stored(spark, sf_dir))


# -- the ingest stream -------------------------------------------------------------------------------

def _ingested(spark: SparkSession, sf_dir: str, run: Callable[..., Iterable[StreamingQuery]]) -> Store:
    root = scratch_dir(spark, "ingest")
    store = Store(spark, f"{root}/store").create()
    store.write_devices(td.devices(spark, sf_dir))

    def write(part: DataFrame) -> None:
        part.write.mode("append").options(**files.JSON_TIMES).json(f"{root}/messages")

    def start() -> Iterable[StreamingQuery]:
        source = files.reading_messages(spark, f"{root}/messages", streaming=True)
        return run(decode.payload_decode(source), store, f"{root}/checkpoint")

    _deliver(td.messages(spark, sf_dir), write, start)
    return store


def _looking_up(*args) -> list[StreamingQuery]:
    return [start_ingest(*args)]


def _with_state(*args) -> list[StreamingQuery]:
    return [start_stateful_ingest(*args)]


@_query
def stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, _looking_up).readings().select(*READING)


@_query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_ingested(spark, sf_dir, _looking_up).metrics())


@_query
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, _looking_up).outcomes().groupBy("outcome").agg(F.sum("rows").alias("rows"))


@_query
def stream_duplicate_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery that the stream rejected as a duplicate, with the stored reading of its key."""
    return _ingested(spark, sf_dir, _looking_up).answers().drop("batch_id")


@_query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, _looking_up).late().select(
        "idempotency_key", "device_id", "metric_type", "window_start", "window_end", _late_us())


@_query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per micro-batch of a stream that is started three times, from the table of its progress."""
    listener = ProgressTable(spark, scratch_dir(spark, "progress"), ("progress",))
    spark.streams.addListener(listener)
    ended = []

    def begin(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
        ended.append(source.writeStream.queryName("progress").foreachBatch(sink).option("checkpointLocation", checkpoint)
                     .trigger(availableNow=True).start())
        return ended[-1]

    try:
        _run_stream(td.deliveries(spark, sf_dir), begin, spark, "progress-stream")
        for query in ended:
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    return listener.rows().groupBy("batch_id").agg(
        F.sum("input_rows").alias("input_rows"), F.min(F.col("rows_per_second") > 0).alias("has_rate"), F.min(F.col("backlog") != "{}").alias("has_backlog"))


@_query
def store_current_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored metrics of the minute that holds the latest accepted reading."""
    store = _ingested(spark, sf_dir, _looking_up)
    latest = store.metrics().agg(F.max("window_start")).first()[0]
    return _rounded(store.current_window(latest + timedelta(seconds=30)))


@_query
def stream_device_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that a stream stores while devices register: each is judged by its device at its arrival."""
    root = scratch_dir(spark, "live")
    store = Store(spark, f"{root}/store").create()
    store.write_devices(td.devices(spark, sf_dir))
    changes = td.late_registrations(spark, sf_dir).withColumns({"_change": F.lit(True), "ingested_at": F.col("received_at")})
    rows = td.messages(spark, sf_dir).withColumn("_change", F.lit(False)).unionByName(changes, allowMissingColumns=True)

    def write(part: DataFrame) -> None:
        part.where("not _change").select("topic", "payload", "ingested_at", "delivery_seq").write.mode("append").options(**files.JSON_TIMES).json(f"{root}/messages")
        part.where("_change").select(*DEVICE_CHANGE.names).write.mode("append").parquet(f"{root}/changes")

    def start() -> Iterable[StreamingQuery]:
        source = decode.payload_decode(files.reading_messages(spark, f"{root}/messages", streaming=True))
        return [start_live_ingest(source, spark.readStream.schema(DEVICE_CHANGE).parquet(f"{root}/changes"), store, f"{root}/checkpoint")]

    _deliver(rows, write, start)
    return store.readings().select(*READING)


@_query
def stateful_stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, _with_state).readings().select(*READING)


@_query
def stateful_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_ingested(spark, sf_dir, _with_state).metrics())


@_query
def stateful_stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, _with_state).outcomes().groupBy("outcome").agg(F.sum("rows").alias("rows"))
