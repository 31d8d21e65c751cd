"""Mixed change batches against a plain loop over the changes."""

import random
from datetime import datetime, timedelta

import pytest
from telemetry_rows import at

from fieldpulse.operators import registry
from fieldpulse.operators.skew import last_before
from fieldpulse.schemas import DEVICE, DEVICE_CHANGE

TS = datetime(2026, 10, 1)


def plain(changes, devices, used):
    """Outcomes by seq and the devices after all changes."""
    held = {row[0]: list(row) for row in devices}
    outcomes = {}
    for kind, device, name, type_, site, latitude, longitude, _, seq in sorted(changes, key=lambda row: (row[7], row[8])):
        if kind == "REGISTER":
            bad = not device or not name or type_ not in ("CAMERA", "GATEWAY", "SENSOR", "EDGE_NODE") or not site or latitude is None or longitude is None
            outcomes[seq] = "INVALID" if bad else "DEVICE_ALREADY_EXISTS" if device in held else "REGISTERED"
            if outcomes[seq] == "REGISTERED":
                held[device] = [device, name, type_, site, (latitude, longitude), TS, TS]
        elif kind == "PATCH":
            outcomes[seq] = ("INVALID" if type_ == "TOASTER" else "NO_FIELDS_TO_UPDATE" if name is None and type_ is None else
                             "DEVICE_NOT_FOUND" if device not in held else "DEVICE_NAME_CANNOT_BE_BLANK" if name is not None and not name.strip() else "UPDATED")
            if outcomes[seq] == "UPDATED":
                row = held[device]
                row[1], row[2], row[6] = name if name is not None else row[1], type_ if type_ is not None else row[2], TS
        else:
            outcomes[seq] = "DEVICE_NOT_FOUND" if device not in held else "DEVICE_HAS_READINGS" if device in used else "DELETED"
            if outcomes[seq] == "DELETED":
                del held[device]
    return outcomes, sorted(map(tuple, held.values()))


@pytest.mark.parametrize("seed", range(3))
def test_mixed_changes_match_a_loop(spark, seed):
    draw, changes = random.Random(seed), []
    ids = ["hot"] * 6 + [f"d{i}" for i in range(8)] + [None]
    for seq in range(400):
        kind = draw.choice(["REGISTER", "REGISTER", "PATCH", "PATCH", "DELETE"])
        changes.append((kind, draw.choice(ids), draw.choice(["n", f"name{seq}", None, " " if kind == "PATCH" else ""]),
                        draw.choice(["SENSOR", "CAMERA", None, "TOASTER"]), "site", 1.0, draw.choice([2.0, 2.0, None]),
                        at("00:00") + timedelta(seconds=draw.randrange(90)), seq))
    devices = [(f"d{i}", f"old{i}", "GATEWAY", "s", (0.0, 0.0), at("00:00"), at("00:00")) for i in range(0, 8, 2)]
    used = ["d0", "d1"]
    frame, table = spark.createDataFrame(changes, DEVICE_CHANGE), spark.createDataFrame(devices, DEVICE)
    readings = spark.createDataFrame([(i,) for i in used * 3], "device_id string")
    outcomes, after = plain(changes, devices, used)
    got = registry.change_outcome(frame, table, readings).collect()
    assert {row.seq: row.outcome for row in got} == outcomes
    assert len(got) == len(changes)
    next_ = registry.apply_changes(frame, table, readings, TS).select(*DEVICE.names).collect()
    assert sorted((*row[:4], tuple(row[4]), *row[5:]) for row in next_) == after


def test_empty_batch_changes_nothing(spark):
    table = spark.createDataFrame([("a", "n", "SENSOR", "s", (0.0, 0.0), at("00:00"), at("00:00"))], DEVICE)
    readings = spark.createDataFrame([], "device_id string")
    assert registry.apply_changes(spark.createDataFrame([], DEVICE_CHANGE), table, readings, TS).collect() == table.collect()


def test_last_value_is_carried_over_tasks(spark):
    """One key over many tasks, with long stretches without a value."""
    rows = [("hot", i, i if i % 97 == 5 else None) for i in range(2000)] + [("one", 1, None), ("one", 2, 7), ("one", 3, None), (None, 1, 1)]
    frame = spark.createDataFrame(rows, "k string, at int, v int")
    got = {(row.k, row.at): row.before for row in last_before(frame.repartition(7), ["k"], ["at"], "v", "before").collect()}
    want, last = {}, {}
    for key, place, value in sorted(rows, key=lambda row: (str(row[0]), row[1])):
        want[key, place] = last.get(key)
        last[key] = value if value is not None else last.get(key)
    assert got == want
