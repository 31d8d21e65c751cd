"""Devices that register while the stream runs, answers, late rows, and windows that end."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from telemetry_rows import DAY0, at

from fieldpulse.functions.files import child_folders, delete_folder
from fieldpulse.functions.times import utc_literal
from fieldpulse.operators.windows import DEFAULT_POLICY, WINDOW_KEYS, drop_too_late, window_metrics
from fieldpulse.schemas import DEVICE, DEVICE_CHANGE
from fieldpulse.session import cached
from fieldpulse.sources import messages as files
from fieldpulse.streaming import ingest, stateful
from fieldpulse.streaming.store import Store
from fieldpulse.streaming.window_counts import WindowCounts

METRICS = ("device_id", "metric_type", "window_start", "average", "p95", "count")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def plain(frame):
    return frame.withColumn("decode_error", F.lit(False))


def register(spark, *rows):
    return spark.createDataFrame([(kind, device, "n", "SENSOR", "s", 0.0, 0.0, at(when), seq) for seq, (kind, device, when) in enumerate(rows)], DEVICE_CHANGE)


def live(spark, store, tmp_path):
    source = plain(files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True))
    changes = spark.readStream.schema(DEVICE_CHANGE).parquet(str(tmp_path / "changes"))
    query = ingest.start_live_ingest(source, changes, store, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return query


def test_a_device_registers_while_the_stream_runs(spark, deliveries, store, tmp_path):
    """Slice 1 rejects it, slice 2 registers it, slice 3 accepts it; a reading that arrived before the registration stays out."""
    store.write_devices(spark.createDataFrame([("d1", "n", "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00"))], DEVICE))
    rows = deliveries(("a", "00:10", "00:13", 1.0), ("b", "00:10", "00:13", 1.0, "d2"), ("c", "01:10", "01:13", 2.0, "d2"), ("early", "01:01", "01:02", 2.0, "d2"),
                      ("b", "00:10", "02:10", 3.0, "d2"), ("gone", "02:20", "02:30", 3.0, "d2"), ("back", "02:40", "02:41", 4.0, "d2"))
    slices = [((0, 1), [("REGISTER", "x", "00:01")]), ((2, 3), [("REGISTER", "d2", "01:05")]),
              ((4, 6), [("DELETE", "x", "02:00"), ("REGISTER", "d2", "02:05"), ("DELETE", "d3", "02:06")])]
    for (first, last), changes in slices:
        rows.where(F.col("delivery_seq").between(first, last)).write.mode("append").parquet(str(tmp_path / "in"))
        register(spark, *changes).write.mode("append").parquet(str(tmp_path / "changes"))
        live(spark, store, tmp_path)
    assert {row.idempotency_key: row.value for row in store.readings().collect()} == {"a": 1.0, "c": 2.0, "b": 3.0, "gone": 3.0, "back": 4.0}
    assert sorted((row.id, row.outcome) for row in store.device_changes().collect()) == [
        ("d2", "DEVICE_ALREADY_EXISTS"), ("d2", "REGISTERED"), ("d3", "DEVICE_NOT_FOUND"), ("x", "DELETED"), ("x", "REGISTERED")]
    assert sorted(row.id for row in store.devices_after(1, 9).collect()) == ["d1", "d2"]
    version = store.fold_devices()
    assert sorted(row.id for row in store.devices(version).collect()) == ["d1", "d2"]
    deltas = store.spark.read.parquet(f"{store.root}/device_deltas")
    assert deltas.count() == 3  # x and d2, then x again: the size of the batches, not of the table


def test_a_device_is_judged_by_its_state_at_arrival(spark, deliveries, store, tmp_path):
    """All in one micro-batch: registered, deleted and registered once more."""
    rows = deliveries(("a", "00:10", "00:30", 1.0, "d"), ("b", "00:10", "01:00", 2.0, "d"), ("c", "01:10", "02:00", 3.0, "d"), ("e", "02:10", "03:00", 4.0, "d"), ("f", "02:10", "05:00", 5.0, "d"))
    rows.write.parquet(str(tmp_path / "in"))
    register(spark, ("REGISTER", "d", "01:00"), ("DELETE", "d", "01:30"), ("REGISTER", "d", "02:30"), ("DELETE", "d", "04:00")).write.parquet(str(tmp_path / "changes"))
    live(spark, store, tmp_path)
    assert sorted(row.idempotency_key for row in store.readings().collect()) == ["b", "e"]


def contents(store):
    return [sorted(map(str, frame.collect())) for frame in (store.readings(), store.metrics(), store.outcomes(), store.rejects(), store.late(), store.answers(), store.device_changes())]


def test_a_failed_batch_is_run_again_as_a_whole(spark, deliveries, store, tmp_path, monkeypatch):
    store.write_devices(spark.createDataFrame([("d1", "n", "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00"))], DEVICE))
    rows = deliveries(("a", "00:10", "00:13", 1.0), ("a", "00:10", "00:14", 2.0), ("b", "00:10", "09:00", 3.0), ("c", "00:20", "00:30", 4.0, "d2"))
    rows.write.parquet(str(tmp_path / "in"))
    register(spark, ("REGISTER", "d2", "00:20")).write.parquet(str(tmp_path / "changes"))
    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_metrics", lambda *_: (_ for _ in ()).throw(RuntimeError("dies here")))
        with pytest.raises(Exception, match="dies here"):
            live(spark, store, tmp_path)
    live(spark, store, tmp_path)
    once = contents(store)
    assert [row.idempotency_key for row in store.late().collect()] == ["b"]
    assert [(row.idempotency_key, row.delivery_seq, row.stored_value) for row in store.answers().collect()] == [("a", 1, 1.0)]
    assert {row.idempotency_key for row in store.readings().collect()} == {"a", "b", "c"}
    live(spark, store, tmp_path)
    assert contents(store) == once


def test_duplicates_are_answered_from_the_batch_that_stored_them(spark, deliveries, store, devices):
    store.write_devices(spark.createDataFrame([("d1", "n", "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00"))], DEVICE))
    full = plain(deliveries(("a", "00:10", "00:13", 1.0), ("b", "00:20", "00:25", 2.0), ("c", "00:30", "00:35", 3.0), ("a", "00:10", "00:40", 9.0),
                            ("c", "00:30", "00:41", 9.0), ("c", "00:30", "00:42", 8.0)))
    for batch_id, part in enumerate((full.where("delivery_seq < 2"), full.where("delivery_seq = 2"), full.where("delivery_seq > 2"))):
        ingest.ingest_batch(part, batch_id, store)
    got = {(row.delivery_seq, row.idempotency_key, row.stored_value, row.stored_ingested_at) for row in store.answers().collect()}
    assert got == {(3, "a", 1.0, at("00:13")), (4, "c", 3.0, at("00:35")), (5, "c", 3.0, at("00:35"))}
    located = store.key_index.seen(full.where("delivery_seq = 4").select("idempotency_key"), 2)
    scan = store.readings_at(located)
    assert {row.batch_id for row in scan.collect()} == {1}
    pruned = scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "batch_id" in pruned and "event_date" in pruned
    store.compact(3)
    ingest.ingest_batch(plain(deliveries(("a", "00:10", "01:40", 5.0))), 3, store)
    assert {row.stored_value for row in store.answers().where("batch_id = 3").collect()} == {1.0}


def window_rows(spark, rows):
    """(device, seconds of the window's start, value, seconds of arrival)."""
    made = [(device, "m", DAY0 + timedelta(seconds=start), value, DAY0 + timedelta(seconds=arrival)) for device, start, value, arrival in rows]
    return spark.createDataFrame(made, "device_id string, metric_type string, window_start timestamp_ntz, value double, ingested_at timestamp_ntz")


def touched(counts, rows, batch_id, **more):
    counts.add(rows, batch_id)
    out = counts.touched(rows.select("device_id", "metric_type", "window_start").distinct(), batch_id, **more).collect()
    counts.merge(batch_id)
    return {(row.device_id, (row.window_start - DAY0).total_seconds()): (row.average, row.p95, row["count"]) for row in out}


def test_counts_of_batches_add_up(spark, tmp_path):
    counts = WindowCounts(spark, str(tmp_path), fanout=2)
    assert touched(counts, window_rows(spark, [("a", 0, float(v), 10) for v in (1, 1, 2, 3)] + [("b", 0, 5.0, 10)]), 0) == {("a", 0): (7 / 4, 3.0, 4), ("b", 0): (5.0, 5.0, 1)}
    assert touched(counts, window_rows(spark, [("a", 0, 1.0, 20)] * 16), 1) == {("a", 0): (23 / 20, 2.0, 20)}
    assert touched(counts, window_rows(spark, [("a", 0, 9.0, 20), ("a", 60, 4.0, 70)]), 2) == {("a", 0): (32 / 21, 3.0, 21), ("a", 60): (4.0, 4.0, 1)}
    assert touched(counts, window_rows(spark, [("a", 0, 9.0, 20)]), 2) == {("a", 0): (32 / 21, 3.0, 21)}  # run again
    assert touched(counts, window_rows(spark, []), 3) == {}


def test_ended_windows_are_dropped_and_clocks_far_off_end_none(spark, tmp_path):
    counts = WindowCounts(spark, str(tmp_path), horizon=timedelta(minutes=5), fanout=2)
    rows, year = 0, 365 * 86_400
    for batch_id in range(8):
        begin = batch_id * 120
        # One reading a year ahead, and one whose arrival clock is a year ahead or behind.
        batch = [("a", begin, 1.0, begin + 30)] * 5 + [("a", year + begin, 2.0, begin + 31), ("a", begin, 3.0, begin + (year if batch_id % 2 else -year))]
        got = touched(counts, window_rows(spark, batch), batch_id)
        assert got["a", begin] == (8 / 6, 3.0, 6) and got["a", year + begin] == (2.0, 2.0, 1)
        rows = counts.held().where(F.col("window_start") < DAY0 + timedelta(days=1)).groupBy("window_start").count().count()
    assert rows < 8  # windows that ended more than the horizon ago are gone
    assert counts.clock() == DAY0 + timedelta(seconds=7 * 120 + 30)
    assert len(counts.runs.live()) <= 5
    before = counts.held().count()
    assert touched(counts, window_rows(spark, [("a", 0, 7.0, 40)]), 8) == {}
    assert counts.held().count() <= before + 1


def test_an_ended_window_is_answered_from_the_readings(spark, deliveries, store, monkeypatch):
    """Processed long after its neighbours, but within the grace period by its own arrival: the stored rows have all it needs."""
    store.write_devices(spark.createDataFrame([("d1", "n", "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00"))], DEVICE))
    monkeypatch.setattr(Store, "window_counts", lambda self, policy=DEFAULT_POLICY: WindowCounts(spark, f"{self.root}/window_counts", policy, fanout=2))
    rows = [deliveries(("a", "00:10", "00:13", 1.0), ("b", "00:20", "00:25", 2.0))]
    rows += [deliveries((f"k{i}", f"{100 * i}:10", f"{100 * i}:13", 1.0)) for i in range(1, 5)]
    rows.append(deliveries(("late", "00:30", "00:50", 6.0)))
    for batch_id, part in enumerate(rows):
        ingest.ingest_batch(plain(part), batch_id, store)
    held = store.window_counts().held().where(F.col("window_start") == at("00:00"))
    assert [row.value for row in held.collect()] == [6.0]  # what came before was dropped
    got = sorted(store.metrics().select(*METRICS).collect())
    assert got == sorted(window_metrics(store.readings()).select(*METRICS).collect())
    assert [row for row in got if row.window_start == at("00:00")][0]["count"] == 3


def test_window_metrics_stream(spark, deliveries, tmp_path):
    full = deliveries(("a", "00:10", "00:13", 1.0), ("f", "59:00", "00:14", 9.0), ("c", "00:30", "01:05", 3.0),
                      ("g", "00:40", "01:10", 4.0), ("t", "00:50", "01:10.000001", 7.0))
    for part in (full.where("delivery_seq < 2"), full.where("delivery_seq >= 2")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True, max_files=1)
    emitted = []
    stateful.window_metrics_stream(source, WindowCounts(spark, str(tmp_path / "counts")), lambda rows, batch: emitted.extend((batch, row) for row in rows.collect()),
                                   str(tmp_path / "checkpoint")).awaitTermination()
    last = {row.window_start: (row.average, row.p95, row["count"]) for _, row in sorted(emitted, key=lambda entry: entry[0])}
    assert last == {at("00:00"): (8 / 3, 4.0, 3), at("59:00"): (9.0, 9.0, 1)}
    assert drop_too_late(full).count() == 4


def test_folders(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    assert child_folders(spark, str(tmp_path / "x")) == ["y"] and child_folders(spark, str(tmp_path / "none")) == []
    delete_folder(spark, str(tmp_path / "x"))
    delete_folder(spark, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()


def test_metrics_of_a_batch_have_tasks_by_their_rows(spark, tmp_path):
    """They are cached before they are written, and AQE leaves the partitions of a cached plan alone."""
    counts, few = WindowCounts(spark, str(tmp_path)), spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(2_000).select(
        F.concat(F.lit("d"), F.col("id") % 50).alias("device_id"), F.lit("m").alias("metric_type"), utc_literal(at("00:00")).alias("window_start"),
        F.col("id").cast("double").alias("value"), utc_literal(at("00:10")).alias("ingested_at"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        counts.add(rows, 0)
        metrics = counts.touched(rows.select(*WINDOW_KEYS).distinct(), 0).persist()
        assert sorted((row.device_id, row["count"]) for row in metrics.collect()) == sorted((f"d{i}", 40) for i in range(50))
        assert metrics.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
    metrics.unpersist()


def test_stored_keys_are_looked_up_once_per_batch(spark, deliveries, store, devices, monkeypatch):
    rows = deliveries(("a", "00:10", "00:12", 1.0), ("b", "00:10", "00:13", 2.0)).withColumn("decode_error", F.lit(False))
    asked, label = [], ingest.label_outcomes
    monkeypatch.setattr(ingest, "label_outcomes", lambda checked, seen, *rest: asked.append(seen) or label(checked, seen, *rest))
    for batch_id in (0, 1):
        ingest.ingest_batch(rows, batch_id, store, devices=devices("d1"))
    assert asked[1].inputFiles() and all("/key_index/" not in name for name in asked[1].inputFiles())
    assert sorted(row.stored_value for row in store.answers().collect()) == [1.0, 2.0]


def test_cached_rows_have_partitions_by_their_size(spark):
    few, name = spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = cached(spark.range(1_000).withColumn("k", F.col("id") % 10).join(spark.range(10).withColumnRenamed("id", "k").hint("merge"), "k", "left"))
        assert rows.count() == 1_000 and rows.rdd.getNumPartitions() == 1
        assert spark.conf.get(name) == before
        rows.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
