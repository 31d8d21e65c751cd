import random
import threading
from datetime import timedelta

import pytest
from telemetry_rows import SF, at
from pyspark import InheritableThread
from pyspark.sql import functions as F

from fieldpulse.functions.files import child_folders
from fieldpulse.operators import decode, outcome
from fieldpulse.operators.dedup import dedup_first_wins
from fieldpulse.operators.windows import window_metrics
from fieldpulse.schemas import DEVICE, READING, READING_REQUEST
from fieldpulse.sources import messages as files
from fieldpulse.sources import testdata as td
from fieldpulse.streaming import ingest, progress, stateful
from fieldpulse.streaming import store as store_module
from fieldpulse.streaming.metric_runs import MetricRuns
from fieldpulse.streaming.store import Store

METRICS = ("device_id", "metric_type", "window_start", "average", "p95", "count")


def plain(frame):
    return frame.withColumn("decode_error", F.lit(False))


def device_rows(spark, *ids):
    return spark.createDataFrame(
        [(i, i, "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00")) for i in ids], DEVICE)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def contents(store):
    return {
        "readings": sorted(map(tuple, store.readings().drop("event_date").collect()), key=str),
        "metrics": sorted(map(tuple, store.metrics().select(*METRICS).collect()), key=str),
        "rejects": sorted(map(str, store.rejects().collect())),
        "outcomes": sorted(map(tuple, store.outcomes().collect())),
    }


def test_stream_gives_the_batch_tables(spark, store, tmp_path):
    """Messages, cut at random arrival times into files, end in the tables that one batch gives."""
    store.write_devices(td.devices(spark, SF))
    messages = td.messages(spark, SF)
    arrivals = sorted(row[0] for row in messages.select("ingested_at").collect())
    cuts = sorted(random.Random(5).sample(arrivals, 2))
    bounds = [arrivals[0], *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = messages.where(F.col("ingested_at") >= F.lit(str(low)).cast("timestamp_ntz"))
        if high:
            part = part.where(F.col("ingested_at") < F.lit(str(high)).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").options(**files.JSON_TIMES).json(str(tmp_path / "in"))
    source = files.reading_messages(spark, str(tmp_path / "in"), streaming=True, max_files=1)
    query = ingest.start_ingest(decode.payload_decode(source), store, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert progress.drain_rate(query) > 0
    assert [set(source) for source in progress.backlog(query).values()] == [{"end_offset", "outstanding"}]

    labelled = outcome.ingest_outcome(decode.payload_decode(messages), td.device_ids(spark, SF))
    stored = outcome.stored_rows(labelled).select(*READING.names)
    assert sorted(store.readings().select(*READING.names).collect(), key=str) == sorted(
        stored.collect(), key=str)
    assert sorted(store.metrics().select(*METRICS).collect(), key=str) == sorted(
        window_metrics(stored).select(*METRICS).collect(), key=str)
    summed = store.outcomes().groupBy("outcome").agg(F.sum("rows").alias("rows"))
    assert sorted(summed.collect()) == sorted(outcome.outcome_counts(labelled).collect())
    assert store.rejects().count() == outcome.rejected_rows(labelled).count()

    before = contents(store)
    again = ingest.start_ingest(decode.payload_decode(source), store, str(tmp_path / "checkpoint"))
    again.awaitTermination()
    assert contents(store) == before


def test_failure_after_the_write_is_replayed_without_copies(spark, store, deliveries, tmp_path, monkeypatch):
    store.write_devices(device_rows(spark, "d1"))
    deliveries(("a", "00:10", "00:11", 1.0), ("a", "00:10", "00:12", 2.0), ("b", "00:10", "00:12", 2.0, "d2"),
               ("c", "00:20", "00:30", 3.0)).write.parquet(str(tmp_path / "in"))
    source = plain(files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(Store, "write_metrics", fail)
    broken = ingest.start_ingest(source, store, str(tmp_path / "checkpoint"))
    with pytest.raises(Exception, match="lost"):
        broken.awaitTermination()
    assert store.readings().count() == 2 and store.metrics().count() == 0

    # Devices registered since then must not change the replay.
    store.write_devices(device_rows(spark, "d1", "d2"))
    monkeypatch.undo()
    ingest.start_ingest(source, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert {row["idempotency_key"] for row in store.readings().collect()} == {"a", "c"}
    assert store.readings().count() == 2
    row = store.metrics().first()
    assert (row["average"], row["p95"], row["count"]) == (2.0, 3.0, 2)
    assert sum(r["rows"] for r in store.outcomes().collect()) == 4


def test_batches_share_windows_keys_and_new_devices(spark, store, deliveries):
    store.write_devices(device_rows(spark, "d1"))
    first = plain(deliveries(("a", "00:10", "00:11", 1.0), ("u", "00:10", "00:12", 5.0, "d2")))
    second = plain(deliveries(("a", "00:10", "00:50", 9.0), ("b", "00:20", "00:51", 3.0),
                              ("late", "00:30", "01:30", 8.0), ("u", "00:10", "00:52", 5.0, "d2")))
    ingest.ingest_batch(first, 0, store)
    store.write_devices(device_rows(spark, "d1", "d2"))
    ingest.ingest_batch(second, 1, store)
    metrics = {row["device_id"]: (row["average"], row["p95"], row["count"])
               for row in store.metrics().collect()}
    assert metrics == {"d1": (2.0, 3.0, 2), "d2": (5.0, 5.0, 1)}
    assert {row["idempotency_key"] for row in store.readings().collect()} == {"a", "b", "late", "u"}

    before = contents(store)
    ingest.ingest_batch(second, 1, store)
    assert contents(store) == before

    store.compact(1)
    assert contents(store) == before
    ingest.ingest_batch(second, 1, store)  # the last batch may still be run again
    assert contents(store) == before


def test_point_read_opens_one_file_of_many(spark, tmp_path):
    runs = MetricRuns(spark, str(tmp_path), file_rows=10, fanout=3)
    names = [f"d{i:02}" for i in range(12)]

    def add(batch_id, windows):
        rows = [(device, "m", at("00:00") + timedelta(minutes=minute), float(batch_id), float(batch_id), batch_id) for device in names for minute in windows]
        runs.add(spark.createDataFrame(rows, "device_id string, metric_type string, window_start timestamp_ntz, average double, p95 double, count long"), batch_id)
        runs.merge(batch_id)
    add(0, range(10))
    files = len(list(tmp_path.glob("runs/*/part=metrics/*.parquet")))
    found = runs.at(at("04:00"), "d07")
    assert files >= 10 and len(found.inputFiles()) == 1
    assert [(row.device_id, row.p95) for row in found.collect()] == [("d07", 0.0)]
    assert len(runs.at(at("04:00")).inputFiles()) <= 4 and runs.at(at("04:00")).count() == 12
    assert runs.at(at("30:00"), "d07").count() == 0
    for batch_id in range(1, 8):
        add(batch_id, range(batch_id, batch_id + 3))
    assert max(run.level for run in runs.runs.live()) >= 1
    latest = {(row.device_id, row.window_start): row.p95 for row in runs.latest().collect()}
    assert latest == {(device, at("00:00") + timedelta(minutes=minute)): float(min(minute, 7)) for device in names for minute in range(10)}
    assert [row.p95 for row in runs.at(at("09:00"), "d03", "m").collect()] == [7.0]


def batch_rows(spark, batch_id):
    rows = [("d1", "m", float(i), at("00:10") + timedelta(days=i % 3), f"{batch_id}-{i}", at("00:20") + timedelta(days=batch_id), batch_id * 10 + i) for i in range(6)]
    return spark.createDataFrame(rows, READING_REQUEST)


def test_compaction_beside_the_stream(spark, store):
    """A thread merges again and again while batches are written and one is run twice: nothing is lost or doubled, and folders stay few."""
    running, failures, done = [0], [], threading.Event()

    def merge():
        while not done.is_set():
            try:
                store.compact(running[0])
            except Exception as failure:
                failures.append(failure)
                return
    thread = InheritableThread(target=merge)
    thread.start()
    try:
        for batch_id in range(12):
            running[0] = batch_id
            for _ in range(2 if batch_id % 5 == 3 else 1):
                store.write_readings(batch_rows(spark, batch_id), batch_id)
                store.write_outcomes(spark.createDataFrame([("ACCEPTED", 6)], "outcome string, rows long"), batch_id)
            seen = store.readings().select("idempotency_key").collect()
            assert sorted(row[0] for row in seen) == sorted(f"{b}-{i}" for b in range(batch_id + 1) for i in range(6))
    finally:
        done.set()
        thread.join()
    assert not failures
    store.compact(12)
    store.compact(12)
    assert sum(row.rows for row in store.outcomes().collect()) == 72 and store.outcomes().count() == 12
    assert store.readings().count() == 72 and store.readings().select("batch_id").distinct().count() == 12
    assert child_folders(spark, f"{store.root}/readings") == child_folders(spark, f"{store.root}/outcomes") == []
    chunks = child_folders(spark, f"{store.root}/chunks/readings")
    assert len(chunks) < 12 and child_folders(spark, f"{store.root}/chunks/readings/{chunks[0]}") == [
        f"event_date={(at('00:10') + timedelta(days=i)).date()}" for i in range(3)]
    located = spark.createDataFrame([(at("00:10").date(), 4)], "event_date date, batch_id long")
    assert {row.idempotency_key for row in store.readings_at(located).collect()} == {"4-0", "4-3"}


def test_of_two_compactions_one_gives_up(spark, store, monkeypatch):
    for batch_id in range(3):
        store.write_readings(batch_rows(spark, batch_id), batch_id)
    plain_write = store_module._overwrite

    def slow(rows, path, *partitions, **more):
        plain_write(rows, path, *partitions, **more)
        monkeypatch.setattr(store_module, "_overwrite", plain_write)
        store.compact(3)
    monkeypatch.setattr(store_module, "_overwrite", slow)
    store.compact(2)
    assert store.readings().count() == 18
    assert len(child_folders(spark, f"{store.root}/chunks/readings")) == 1


@pytest.mark.parametrize("max_broadcast", [ingest.MAX_BROADCAST_BYTES, 0])
def test_stateful_ingest_gives_the_same_readings(spark, store, deliveries, tmp_path, max_broadcast):
    store.write_devices(device_rows(spark, "d1"))
    full = deliveries(
        ("a", "00:10", "00:13", 3.0), ("a", "00:10", "00:11", 1.0), ("u", "00:10", "00:12", 5.0, "d2"),
        ("bad", "00:10", "00:14", None), ("b", "00:20", "00:15", 2.0), ("a", "00:10", "00:50", 9.0),
        ("late", "00:30", "01:30", 8.0), ("late", "00:30", "01:31", 8.0), ("c", "00:40", "01:05", 4.0))
    files_in_order(tmp_path, full.where("delivery_seq < 5"), full.where("delivery_seq BETWEEN 5 AND 8"))

    def drain():
        source = plain(files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True,
                                              max_files=1))
        ingest.start_stateful_ingest(source, store, str(tmp_path / "checkpoint"), max_broadcast=max_broadcast).awaitTermination()

    drain()
    labelled = outcome.ingest_outcome(plain(full), device_rows(spark, "d1").select("id"))
    stored = outcome.stored_rows(labelled).select(*READING.names)
    assert sorted(store.readings().select(*READING.names).collect(), key=str) == sorted(
        stored.collect(), key=str)
    assert sorted(store.metrics().select(*METRICS).collect(), key=str) == sorted(
        window_metrics(stored).select(*METRICS).collect(), key=str)
    assert {(row["idempotency_key"], row["outcome"]) for row in store.rejects().collect()} == {
        ("u", "DEVICE_NOT_FOUND"), ("bad", "INVALID")}
    summed = store.outcomes().groupBy("outcome").agg(F.sum("rows").alias("rows"))
    assert sorted(summed.collect()) == sorted(outcome.outcome_counts(labelled).collect())

    # A later run knows the keys of the earlier one, and the devices registered since.
    store.write_devices(device_rows(spark, "d1", "d2"))
    files_in_order(tmp_path, deliveries(("u", "00:10", "00:55", 6.0, "d2"), ("a", "00:10", "00:56", 7.0)))
    drain()
    assert {(row["idempotency_key"], row["value"]) for row in store.readings().collect()} == {
        ("a", 1.0), ("b", 2.0), ("late", 8.0), ("c", 4.0), ("u", 6.0)}


def test_half_failed_stateful_batch_is_replayed_with_its_devices(spark, store, deliveries, tmp_path, monkeypatch):
    """Whichever write fails, no reading is lost or stored twice, even if its device registers before the restart."""
    store.write_devices(device_rows(spark, "d1"))
    files_in_order(tmp_path, deliveries(("a", "00:10", "00:11", 1.0), ("a", "00:10", "00:12", 2.0), ("u", "00:10", "00:12", 5.0, "d2")))
    source = plain(files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True, max_files=1))

    def start():
        return ingest.start_stateful_ingest(source, store, str(tmp_path / "checkpoint"))

    def fail(*_):
        raise RuntimeError("lost")

    for write in ("write_rejects", "write_readings"):
        monkeypatch.setattr(Store, write, fail)
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
        monkeypatch.undo()
        store.write_devices(device_rows(spark, "d1", "d2"))
    start().awaitTermination()
    assert [(row["idempotency_key"], row["value"]) for row in store.readings().collect()] == [("a", 1.0)]
    assert [row["idempotency_key"] for row in store.rejects().collect()] == ["u"]
    assert {row["outcome"]: row["rows"] for row in store.outcomes().collect()} == {
        "ACCEPTED": 1, "DUPLICATE": 1, "DEVICE_NOT_FOUND": 1}

    # The next batch knows the new device, and the key was left free.
    files_in_order(tmp_path, deliveries(("u", "00:10", "00:13", 6.0, "d2"), ("a", "00:10", "00:14", 7.0)))
    start().awaitTermination()
    assert sorted((row["idempotency_key"], row["value"]) for row in store.readings().collect()) == [("a", 1.0), ("u", 6.0)]


def test_point_read_of_a_stored_window(spark, store, deliveries, capsys):
    store.write_devices(device_rows(spark, "d1", "d2"))
    ingest.ingest_batch(plain(deliveries(("a", "00:10", "00:11", 1.0), ("b", "00:10", "00:12", 5.0, "d2"))), 0, store)
    ingest.ingest_batch(plain(deliveries(("c", "00:20", "00:51", 3.0), ("d", "01:20", "01:21", 9.0))), 1, store)
    found = store.current_window(at("00:59"), "d1", "temperature")
    assert [(row["average"], row["p95"], row["count"]) for row in found.collect()] == [(2.0, 3.0, 2)]
    assert {row["device_id"] for row in store.current_window(at("00:00")).collect()} == {"d1", "d2"}
    assert store.current_window(at("07:00")).count() == 0 and store.current_window(at("00:30"), "d3").count() == 0
    capsys.readouterr()
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(device_id,d1)" in plan and "EqualTo(window_start" in plan
    assert len(found.inputFiles()) == 2  # one per run


def test_empty_batch(spark, store, deliveries):
    ingest.ingest_batch(plain(deliveries(("a", "00:10", "00:11", 1.0)).where("false")), 0, store)
    assert store.readings().count() == store.metrics().count() == store.rejects().count() == 0


def test_two_transports_in_one_stream(spark, store, deliveries, tmp_path):
    store.write_devices(device_rows(spark, "d1"))
    frame = deliveries(("a", "00:10", "00:11", 1.0), ("b", "00:10", "00:12", 2.0))
    frame.write.parquet(str(tmp_path / "http"))
    td.as_messages(deliveries(("b", "00:10", "00:13", 5.0), ("c", "00:10", "00:14", 6.0))).write.options(
        **files.JSON_TIMES).json(str(tmp_path / "mqtt"))
    direct = files.reading_requests(spark, str(tmp_path / "http"), "parquet", streaming=True)
    decoded = decode.payload_decode(files.reading_messages(spark, str(tmp_path / "mqtt"), streaming=True))
    merged = decode.merge_transports(decoded, direct)
    ingest.start_ingest(merged, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert {(row["idempotency_key"], row["value"]) for row in store.readings().collect()} == {
        ("a", 1.0), ("b", 2.0), ("c", 6.0)}


def run(stream, tmp_path, mode):
    stream.writeStream.outputMode(mode).foreachBatch(
        lambda rows, batch_id: rows.write.parquet(str(tmp_path / f"out/batch={batch_id}"))
    ).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start(
    ).awaitTermination()
    return stream.sparkSession.read.parquet(str(tmp_path / "out"))


def files_in_order(tmp_path, *frames):
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_dedup_stream_is_first_wins_within_and_across_batches(spark, deliveries, tmp_path):
    full = deliveries(("a", "00:10", "00:13", 3.0), ("a", "00:10", "00:11", 1.0), ("b", "00:10", "00:12", 2.0),
                      ("a", "00:10", "00:20", 8.0), ("c", "00:10", "00:21", 4.0), ("c", "00:10", "00:21", 5.0))
    again = full.where("delivery_seq = 4")  # an identical copy of the first c
    files_in_order(tmp_path, full.where("delivery_seq < 3"), full.where("delivery_seq >= 3").unionByName(again))
    source = files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True, max_files=1)
    failures = [1]

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch_id}"))
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("after the write, before the commit")

    def start():
        return stateful.dedup_stream(source, write, str(tmp_path / "checkpoint"))

    with pytest.raises(Exception, match="before the commit"):
        start().awaitTermination()
    query = start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(*READING_REQUEST.names)
    assert sorted(got.collect(), key=str) == sorted(dedup_first_wins(full).collect(), key=str)
    state = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert state[-1]["numRowsTotal"] == 3


def test_dedup_stream_within_a_horizon(spark, deliveries, tmp_path):
    full = deliveries(("a", "00:10", "00:13", 1.0), ("b", "00:10", "00:14", 1.0), ("a", "00:10", "00:20", 1.0))
    files_in_order(tmp_path, full.where("delivery_seq < 2"), full.where("delivery_seq = 2"))
    source = files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True, max_files=1)
    got = run(stateful.dedup_stream_within(source, "1 hour"), tmp_path, "append")
    assert sorted(row["delivery_seq"] for row in got.collect()) == [0, 1]


def test_stream_late_counters(spark, deliveries, tmp_path):
    full = deliveries(("a", "00:10", "00:13", 1.0), ("f", "59:00", "00:14", 9.0), ("c", "00:30", "01:05", 3.0),
                      ("g", "00:40", "01:10", 4.0), ("t", "00:50", "01:10.000001", 7.0))
    files_in_order(tmp_path, full.where("delivery_seq < 2"), full.where("delivery_seq >= 2"))
    source = files.reading_requests(spark, str(tmp_path / "in"), "parquet", streaming=True, max_files=1)
    query = stateful.observe_late(source).writeStream.format("noop").trigger(availableNow=True).start()
    query.awaitTermination()
    seen = [p["observedMetrics"]["late"] for p in query.recentProgress if p["numInputRows"]]
    assert (sum(s["late_accepted"] for s in seen), sum(s["late_dropped"] for s in seen)) == (2, 1)
