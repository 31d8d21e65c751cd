import pytest
from telemetry_rows import at

from fieldpulse.operators import registry, validate
from fieldpulse.schemas import DEVICE_PATCH, DEVICE_REQUEST, READING_REQUEST


def reading_errors(spark, metric="t", value=1.0, key="k"):
    frame = spark.createDataFrame([("d", metric, value, None, key, at("00:00"), 1)], READING_REQUEST)
    return [(v["field"], v["message"]) for v in validate.validate_readings(frame).first()["violations"]]


@pytest.mark.parametrize("metric, messages", [
    ("m" * 32, []),
    ("m" * 33, ["size must be between 0 and 32"]),
    ("", ["must not be blank"]),
    ("\t", ["must not be blank"]),
    (None, ["must not be blank"]),
    ("\x00\n ", ["must not be blank"]),
    (" " * 33, ["must not be blank", "size must be between 0 and 32"]),
    ("\u00a0", []),
    (" \u2028", []),
])
def test_metric_type(spark, metric, messages):
    assert reading_errors(spark, metric=metric) == [("metricType", m) for m in messages]


def test_several_violations(spark):
    assert reading_errors(spark, value=None, key=" ") == [
        ("value", "must not be null"), ("idempotencyKey", "must not be blank")]


def device_errors(spark, **changes):
    row = {"id": "d", "device_name": "n", "device_type": "SENSOR", "site": "s", "latitude": 0.0,
           "longitude": 0.0, "received_at": at("00:00"), "seq": 1, **changes}
    frame = spark.createDataFrame([tuple(row[n] for n in DEVICE_REQUEST.names)], DEVICE_REQUEST)
    checked = validate.validate_devices(frame)
    listed = validate.violation_list(checked, "seq").collect()
    assert len(listed) == len(checked.first()["violations"])
    return [(v["field"], v["message"]) for v in listed]


@pytest.mark.parametrize("changes, expected", [
    ({}, []),
    ({"latitude": 90.0, "longitude": -180.0}, []),
    ({"latitude": 90.0001}, [("latitude", "must be less than or equal to 90.0")]),
    ({"latitude": -90.5}, [("latitude", "must be greater than or equal to -90.0")]),
    ({"longitude": 180.1}, [("longitude", "must be less than or equal to 180.0")]),
    ({"latitude": None}, [("latitude", "must not be null")]),
    ({"id": "i" * 64, "device_name": "n" * 128}, []),
    ({"id": "i" * 65}, [("id", "size must be between 0 and 64")]),
    ({"device_name": "n" * 129}, [("deviceName", "size must be between 0 and 128")]),
    ({"device_type": None}, [("deviceType", "must not be null")]),
    ({"device_type": "TOASTER"},
     [("deviceType", "must be one of CAMERA, GATEWAY, SENSOR, EDGE_NODE")]),
    ({"site": " ", "id": None}, [("id", "must not be blank"), ("site", "must not be blank")]),
])
def test_device_requests(spark, changes, expected):
    assert device_errors(spark, **changes) == expected


@pytest.mark.parametrize("device, name, kind, error", [
    ("d1", "new", None, None),
    ("d1", None, "CAMERA", None),
    ("d1", None, None, "NO_FIELDS_TO_UPDATE"),
    ("nope", None, None, "NO_FIELDS_TO_UPDATE"),
    ("nope", "  ", None, "DEVICE_NOT_FOUND"),
    ("nope", "n" * 129, None, "INVALID"),
    ("d1", "  ", None, "DEVICE_NAME_CANNOT_BE_BLANK"),
    ("d1", "", "CAMERA", "DEVICE_NAME_CANNOT_BE_BLANK"),
    ("d1", "\u2003\u3000", None, "DEVICE_NAME_CANNOT_BE_BLANK"),
    ("d1", "\u00a0", None, None),
    ("d1", "n" * 128, None, None),
    ("d1", None, "TOASTER", "INVALID"),
])
def test_patches(spark, devices, device, name, kind, error):
    patch = spark.createDataFrame([(device, name, kind, at("00:00"), 1)], DEVICE_PATCH)
    assert registry.patch_outcome(patch, devices("d1")).first()["error"] == error
