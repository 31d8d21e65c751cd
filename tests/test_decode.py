import json

import pytest
from telemetry_rows import at
from pyspark.sql import functions as F

from fieldpulse.operators import decode
from fieldpulse.schemas import MESSAGE
from fieldpulse.sources import messages as files

GOOD = {"metricType": "temperature", "value": 21.5, "recordedAt": "2026-09-25T00:15:30.123Z",
        "idempotencyKey": "k1"}


@pytest.fixture
def decoded(spark):
    def run(payload, topic="devices/dev-7/readings"):
        text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
        frame = spark.createDataFrame([(topic, text, at("15:31"), 1)], MESSAGE)
        return decode.payload_decode(frame).first()
    return run


def test_good_message(decoded):
    row = decoded(GOOD)
    assert not row["decode_error"]
    assert (row["device_id"], row["metric_type"], row["value"], row["idempotency_key"]) == (
        "dev-7", "temperature", 21.5, "k1")
    assert row["recorded_at"] == at("15:30.123")


@pytest.mark.parametrize("payload", [
    "{bad", "", None, "null", "5", "[]", "{'value': 1.0}", '{"value": NaN}',
    '{"value": "NaN"}', {**GOOD, "value": "x"}, {**GOOD, "value": "1.5"},
    {**GOOD, "recordedAt": "yesterday"}, {**GOOD, "recordedAt": "2026-09-25T00:15:30"},
])
def test_unreadable_message(decoded, payload):
    row = decoded(payload)
    assert row["decode_error"] and row["metric_type"] is None and row["value"] is None


@pytest.mark.parametrize("time, expected", [
    ("2026-09-25T00:15:30Z", "15:30"),
    ("2026-09-25T00:15:30.123456Z", "15:30.123456"),
    ("2026-09-25T00:15:30.123456789Z", "15:30.123456"),
    ("2026-09-25T02:15:30+02:00", "15:30"),
])
def test_instants(decoded, time, expected):
    assert decoded({**GOOD, "recordedAt": time})["recorded_at"] == at(expected)


def test_instants_do_not_depend_on_the_session_zone(spark, decoded):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert decoded(GOOD)["recorded_at"] == at("15:30.123")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_fields(decoded):
    assert not decoded({**GOOD, "extra": {"a": 1}})["decode_error"]
    missing = decoded({"metricType": "t"})
    assert not missing["decode_error"] and missing["value"] is None and missing["recorded_at"] is None


def test_topics(spark):
    topics = ["devices/a/readings", "devices//readings", "devices/a/b/readings", "devices/a/status",
              "devices/readings", "x/devices/a/readings", "devices/a/readings/"]
    frame = spark.createDataFrame([(t, "{}", at("00:00"), i) for i, t in enumerate(topics)], MESSAGE)
    assert {row["topic"] for row in decode.topic_match(frame).collect()} == set(topics[:2])
    ids = frame.select("topic", decode.topic_device_id(F.col("topic")).alias("id")).collect()
    assert {row["topic"]: row["id"] for row in ids}["devices//readings"] == ""
    lone = spark.createDataFrame([("abc",)], "topic string").select(decode.topic_device_id(F.col("topic")))
    assert lone.first()[0] is None


def test_each_payload_is_parsed_once(spark, capsys):
    frame = spark.createDataFrame([("devices/a/readings", "{}", at("00:00"), 1)], MESSAGE)
    requests = decode.recorded_at_default(decode.reading_requests(frame))
    requests.where("value > 3 AND idempotency_key <> ''").explain()
    assert capsys.readouterr().out.count("from_json(") == 1


def test_files_round_trip_with_microseconds(spark, deliveries, tmp_path):
    frame = deliveries(("a", "00:10.123456", "00:12.000001", 7.25), ("b", None, "00:13", None))
    frame.write.options(**files.JSON_TIMES).json(str(tmp_path / "in"))
    assert sorted(files.reading_requests(spark, str(tmp_path / "in")).collect(), key=str) == sorted(
        frame.collect(), key=str)


def test_kafka_layout(spark):
    records = spark.sql("""
        SELECT CAST(t AS BINARY) AS key, CAST('{}' AS BINARY) AS value, 'readings' AS topic, p AS partition,
               o AS offset, TIMESTAMP '2026-09-25 00:00:01' AS timestamp
        FROM VALUES ('devices/a/readings', 0, 5L), ('devices/a/readings', 1, 5L), ('other', 0, 6L)
          AS v(t, p, o)""")
    rows = files.messages_from_kafka(records).collect()
    assert [row["ingested_at"] for row in rows] == [at("00:01"), at("00:01")]
    assert {row["delivery_seq"] for row in rows} == {5 * 65536, 5 * 65536 + 1}


def test_arrival_comes_from_the_system(spark):
    frame = spark.range(1)
    stamped = files.ingest_stamp(frame).selectExpr("ingested_at", "current_timestamp() AS now").first()
    assert abs((stamped["now"] - stamped["ingested_at"]).total_seconds()) < 5
