from telemetry_rows import SF, at
from pyspark.sql import functions as F

from fieldpulse.operators import outcome
from fieldpulse.operators.referential import reading_with_device
from fieldpulse.operators.windows import window_metrics
from fieldpulse.sources import testdata as td


def plain(frame):
    return frame.withColumn("decode_error", F.lit(False))


def labels(frame, devices, seen=None):
    rows = outcome.ingest_outcome(plain(frame), devices, seen).collect()
    return [row["outcome"] for row in sorted(rows, key=lambda row: row["delivery_seq"])]


SEQUENCE = (
    ("a", "00:10", "00:11", 1.0), ("b", "00:20", "00:21", 2.0), ("b", "00:20", "00:22", 2.0),
    ("c", "00:30", "01:05", 3.0), ("future", "05:00", "01:06", 9.0), ("b", "00:20", "01:07", 2.0),
    ("graced", "00:40", "01:09", 4.0), ("toolate", "00:50", "01:11", 7.0),
)


def test_sequence(deliveries, devices):
    frame = deliveries(*SEQUENCE)
    assert labels(frame, devices("d1")) == [
        "ACCEPTED", "ACCEPTED", "DUPLICATE", "ACCEPTED_LATE", "ACCEPTED", "DUPLICATE", "ACCEPTED_LATE",
        "DROPPED_LATE"]
    stored = outcome.stored_rows(outcome.ingest_outcome(plain(frame), devices("d1"))).drop("window_start")
    assert stored.count() == 6
    metrics = {row["window_start"]: (row["average"], row["p95"], row["count"])
               for row in window_metrics(stored).collect()}
    assert metrics == {at("00:00"): (2.5, 4.0, 4), at("05:00"): (9.0, 9.0, 1)}


def test_unknown_device_leaves_the_key_free(deliveries, devices, spark):
    frame = deliveries(("a", "00:10", "00:11", 1.0), ("a", "00:10", "00:12", 1.0, "d2"),
                       ("a", "00:10", "00:13", 1.0))
    assert labels(frame, devices("d2")) == ["DEVICE_NOT_FOUND", "ACCEPTED", "DEVICE_NOT_FOUND"]
    assert labels(frame, devices("d1", "d2")) == ["ACCEPTED", "DUPLICATE", "DUPLICATE"]


def test_too_late_reading_uses_its_key(deliveries, devices):
    frame = deliveries(("a", "00:10", "02:00", 1.0), ("a", "00:10", "02:01", 1.0))
    assert labels(frame, devices("d1")) == ["DROPPED_LATE", "DUPLICATE"]


def test_missing_time_counts_as_first_arrival(deliveries, devices):
    frame = deliveries(("a", None, "00:11", 1.0), ("a", None, "03:00", 1.0))
    assert labels(frame, devices("d1")) == ["ACCEPTED", "DUPLICATE"]
    stored = outcome.stored_rows(outcome.ingest_outcome(plain(frame), devices("d1"))).collect()
    assert [row["recorded_at"] for row in stored] == [at("00:11")]


def test_invalid_rows_leave_the_key_free(deliveries, devices):
    frame = deliveries(("a", "00:10", "00:11", None), ("a", "00:10", "00:12", 1.0),
                       (" ", "00:10", "00:12", 1.0))
    assert labels(frame, devices("d1")) == ["INVALID", "ACCEPTED", "INVALID"]


def test_keys_stored_earlier(deliveries, devices, spark):
    seen = spark.createDataFrame([("a",)], "idempotency_key string")
    frame = deliveries(("a", "00:10", "00:11", 1.0), ("b", "00:10", "00:12", 1.0))
    assert labels(frame, devices("d1"), seen) == ["DUPLICATE", "ACCEPTED"]


def test_counts_add_up(spark):
    labelled = outcome.ingest_outcome(plain(td.faulty_requests(spark, SF)), td.device_ids(spark, SF))
    counts = {row["outcome"]: row["rows"] for row in outcome.outcome_counts(labelled).collect()}
    assert sum(counts.values()) == td.deliveries(spark, SF).count()
    stored = outcome.stored_rows(labelled)
    assert stored.count() == stored.select("idempotency_key").distinct().count() == sum(
        counts.get(name, 0) for name in outcome.STORED)
    windows = window_metrics(stored.drop("window_start"))
    assert windows.agg(F.sum("count")).first()[0] == counts["ACCEPTED"] + counts["ACCEPTED_LATE"]
    assert outcome.rejected_rows(labelled).count() == counts["INVALID"] + counts["DEVICE_NOT_FOUND"]
    assert outcome.counted_rows(labelled).count() == counts["ACCEPTED"] + counts["ACCEPTED_LATE"]


def test_golden_counts(spark):
    sf = SF.replace("0.001", "0.01")
    labelled = outcome.ingest_outcome(plain(td.deliveries(spark, sf)), td.device_ids(spark, sf))
    assert {row["outcome"]: row["rows"] for row in outcome.outcome_counts(labelled).collect()} == {
        "ACCEPTED": 2289, "ACCEPTED_LATE": 743, "DROPPED_LATE": 5998, "DUPLICATE": 460,
        "DEVICE_NOT_FOUND": 1010}


def test_hot_device_join_is_split(spark, capsys):
    """A device with a third of the rows: the join of a large device table splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        readings = spark.range(0, 60_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'd' || id END AS device_id", "uuid() AS payload")
        table = spark.range(60_000).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE 'd' || id END AS id")
        joined = reading_with_device(readings, table)
        assert len(joined.collect()) == 60_000
        joined.explain()
        assert "SortMergeJoin(skew=true)" in capsys.readouterr().out
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
