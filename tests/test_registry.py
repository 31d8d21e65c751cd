from datetime import datetime

import pytest
from telemetry_rows import at

from fieldpulse.operators import registry, views
from fieldpulse.schemas import DEVICE, DEVICE_PATCH, DEVICE_REQUEST

CREATED = datetime(2026, 1, 1)
BATCH = datetime(2026, 2, 1)


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame(
        [(i, f"name {i}", "SENSOR", "site", (1.0, 2.0), CREATED, CREATED) for i in ("d1", "d2", "d3")],
        DEVICE)


def requests(spark, *rows):
    return spark.createDataFrame(
        [(i, name, "CAMERA", "s", 1.0, lat, at("00:00"), seq) for seq, (i, name, lat) in enumerate(rows)],
        DEVICE_REQUEST)


def test_register(spark, snapshot):
    batch = requests(spark, ("d1", "again", 0.0), ("n1", "first", 0.0), ("n1", "second", 0.0),
                     ("n2", "bad", 999.0), ("n2", "good", 0.0))
    outcomes = {row["seq"]: row["outcome"] for row in
                registry.register_outcome(batch, snapshot).collect()}
    assert outcomes == {0: "DEVICE_ALREADY_EXISTS", 1: "REGISTERED", 2: "DEVICE_ALREADY_EXISTS",
                        3: "INVALID", 4: "REGISTERED"}
    after = {row["id"]: row for row in registry.register_devices(batch, snapshot, BATCH).collect()}
    assert {i: row["device_name"] for i, row in after.items()} == {
        "d1": "name d1", "d2": "name d2", "d3": "name d3", "n1": "first", "n2": "good"}
    assert after["n1"]["created_at"] == after["n1"]["updated_at"] == BATCH
    assert after["d1"]["created_at"] == CREATED


def test_get(spark, snapshot):
    ids = spark.createDataFrame([("d1",), ("nope",)], "id string")
    found = {row["id"]: row["found"] for row in registry.get_devices(ids, snapshot).collect()}
    assert found == {"d1": True, "nope": False}
    assert registry.list_devices(snapshot).count() == 3


def test_patch(spark, snapshot):
    patches = spark.createDataFrame([
        ("d1", "one", None, at("00:01"), 1),
        ("d1", None, "CAMERA", at("00:02"), 2),
        ("d1", "two", None, at("00:03"), 3),
        ("d1", " ", None, at("00:04"), 4),
        ("d2", None, None, at("00:05"), 5),
        ("nope", "x", None, at("00:06"), 6),
    ], DEVICE_PATCH)
    after = {row["id"]: row for row in registry.patch_devices(patches, snapshot, BATCH).collect()}
    assert set(after) == {"d1", "d2", "d3"}
    assert (after["d1"]["device_name"], after["d1"]["device_type"]) == ("two", "CAMERA")
    assert (after["d1"]["created_at"], after["d1"]["updated_at"]) == (CREATED, BATCH)
    assert after["d1"]["site"] == "site" and after["d1"]["location"]["latitude"] == 1.0
    assert after["d2"]["updated_at"] == CREATED


def test_delete(spark, snapshot, deliveries):
    readings = deliveries(("a", "00:01", "00:02", 1.0, "d2"))
    deletes = spark.createDataFrame([
        ("d1", at("00:00"), 1), ("d1", at("00:01"), 2), ("d2", at("00:00"), 3), ("nope", at("00:00"), 4),
    ], "id string, received_at timestamp_ntz, seq long")
    outcomes = {row["seq"]: row["outcome"] for row in
                registry.delete_outcome(deletes, snapshot, readings).collect()}
    assert outcomes == {1: "DELETED", 2: "DEVICE_NOT_FOUND", 3: "DEVICE_HAS_READINGS",
                        4: "DEVICE_NOT_FOUND"}
    after = registry.delete_devices(deletes, snapshot, readings)
    assert {row["id"] for row in after.collect()} == {"d2", "d3"}


def test_location_round_trip(snapshot):
    flat = views.location_flatten(snapshot)
    assert sorted(views.location_pack(flat).select(*DEVICE.names).collect()) == sorted(snapshot.collect())
    assert views.device_view(snapshot).columns == [
        "id", "device_name", "device_type", "site", "latitude", "longitude", "created_at", "updated_at"]
