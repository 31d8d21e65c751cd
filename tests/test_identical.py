"""Deliveries that repeat bit by bit, collide in their number, are cut, or lack an arrival time."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import decode, dedup, outcome, registry, validate
from fieldpulse.schemas import DEVICE_REQUEST
from fieldpulse.sources import messages


@pytest.fixture
def plain(deliveries):
    return lambda *rows: deliveries(*rows).withColumn("decode_error", F.lit(False))


def labels(frame):
    return Counter(row.outcome for row in frame.collect())


def test_of_identical_deliveries_one_is_accepted(plain, devices):
    one = plain(("a", "00:10", "00:20", 1.0))
    rows = one.unionByName(one).unionByName(one)
    assert labels(outcome.ingest_outcome(rows, devices("d1"))) == {"ACCEPTED": 1, "DUPLICATE": 2}


def test_of_colliding_deliveries_one_is_stored(plain, devices):
    one, other = plain(("a", "00:10", "00:20", 1.0)), plain(("a", "00:10", "00:20", 2.0))
    labelled = outcome.ingest_outcome(one.unionByName(other), devices("d1"))
    assert labels(labelled) == {"ACCEPTED": 1, "DUPLICATE": 1}
    stored = outcome.stored_rows(labelled).collect()
    assert [row.value for row in stored] == [row.value for row in dedup.dedup_first_wins(one.unionByName(other)).collect()]


def test_identical_copies_are_answered(deliveries):
    one = deliveries(("a", "00:10", "00:20", 1.0))
    answers = dedup.resolve_duplicates(one.unionByName(one).unionByName(one), one)
    assert [row.stored_value for row in answers.collect()] == [1.0, 1.0]


def test_identical_registrations_count_once(spark):
    row = ("d9", "n", "SENSOR", "s", 1.0, 2.0, None, 1)
    requests = spark.createDataFrame([row, row], DEVICE_REQUEST).withColumn(
        "device_type", F.lit(validate.DEVICE_TYPES[0])).withColumn("received_at", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    devices = spark.createDataFrame([], "id string")
    assert labels(registry.register_outcome(requests, devices)) == {"REGISTERED": 1, "DEVICE_ALREADY_EXISTS": 1}


def test_every_line_gets_a_label(spark, devices, tmp_path):
    good = '{"topic": "devices/d1/telemetry", "payload": "{}", "ingested_at": "2026-09-25T00:00:20.000000", "delivery_seq": 1}'
    topic = decode.TOPIC_PATTERN
    (tmp_path / "capture.json").write_text(good + "\n" + good[:40] + "\n")
    read = messages.reading_messages(spark, str(tmp_path))
    whole = spark.read.text(str(tmp_path)).where(F.get_json_object("value", "$.topic").rlike(topic)).count()
    assert read.count() == whole + 1
    assert labels(outcome.ingest_outcome(decode.payload_decode(read), devices("d1")))["DECODE_ERROR"] >= 1


def test_missing_arrival_is_invalid(plain, devices):
    rows = plain(("a", "00:10", "00:20", 1.0)).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    assert labels(outcome.ingest_outcome(rows, devices("d1"))) == {"INVALID": 1}


def test_lengths_count_utf16_units(spark):
    from fieldpulse.functions.text import longer_than
    row = spark.sql("SELECT repeat('\U0001F600', 20) AS t").select(longer_than(F.col("t"), 39).alias("a"), longer_than(F.col("t"), 40).alias("b")).first()
    assert (row.a, row.b) == (True, False)
