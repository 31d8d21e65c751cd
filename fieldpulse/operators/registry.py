"""The device registry as a table: batches of change rows applied to a snapshot.

Change rows carry ``received_at`` and ``seq``; that pair orders a batch and ``seq`` is unique in it. Every
function returns either a label per change row or the next snapshot. ``batch_ts`` is a parameter, so that
a repeated run gives the same table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.times import utc_literal
from fieldpulse.operators.dedup import dedup_first_wins, mark_first
from fieldpulse.operators.skew import last_before
from fieldpulse.operators.validate import DEVICE_NOT_FOUND, INVALID, patch_error, valid, validate_devices
from fieldpulse.operators.views import location_pack

# Fixed values.
REGISTERED = "REGISTERED"
DEVICE_ALREADY_EXISTS = "DEVICE_ALREADY_EXISTS"
UPDATED = "UPDATED"
DELETED = "DELETED"
DEVICE_HAS_READINGS = "DEVICE_HAS_READINGS"

REGISTER = "REGISTER"
PATCH = "PATCH"
DELETE = "DELETE"

ORDER = ("received_at", "seq")


def register_outcome(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Adds ``outcome``: an id in the snapshot, or earlier in the batch, already exists."""
    checked = validate_devices(requests)
    marked = mark_first(checked, "id", ORDER, eligible=F.size("violations") == 0, seen=devices)
    return marked.withColumn(
        "outcome",
        F.when(F.size("violations") > 0, INVALID)
        .when(F.col("is_first"), REGISTERED)
        .otherwise(DEVICE_ALREADY_EXISTS),
    ).drop("is_first")


def register_devices(requests: DataFrame, devices: DataFrame, batch_ts: datetime) -> DataFrame:
    """The next snapshot, with the first valid request of each new id."""
    first = dedup_first_wins(valid(validate_devices(requests)).drop("violations"), "id", ORDER)
    new = (location_pack(first.join(devices.select("id"), "id", "left_anti"))
           .withColumns({"created_at": utc_literal(batch_ts), "updated_at": utc_literal(batch_ts)}))
    return devices.unionByName(new.select(*devices.columns))


def get_devices(ids: DataFrame, devices: DataFrame) -> DataFrame:
    """The devices asked for, with ``found``; unknown ids keep their row."""
    present = devices.withColumn("found", F.lit(True))
    return ids.join(present, "id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def list_devices(devices: DataFrame) -> DataFrame:
    return devices


def patch_outcome(patches: DataFrame, devices: DataFrame) -> DataFrame:
    """Adds ``error``: the first failing check of each patch, or null."""
    known = devices.select("id", F.lit(True).alias("_found"))
    return (patches.join(known, "id", "left")
            .withColumn("error", patch_error(F.coalesce("_found", F.lit(False))))
            .drop("_found"))


def patch_devices(patches: DataFrame, devices: DataFrame, batch_ts: datetime) -> DataFrame:
    """The next snapshot. Of each field, the last value given wins; absent fields are kept."""
    # Patches of unknown devices fall away in the join below, so they need no check of their own here.
    good = patches.where(patch_error(F.lit(True)).isNull())
    folded = good.groupBy("id").agg(*[
        F.expr(f"max_by({name}, struct({', '.join(ORDER)})) FILTER (WHERE {name} IS NOT NULL)")
        .alias(f"_{name}") for name in ("device_name", "device_type")
    ], F.lit(True).alias("_patched"))
    return (devices.join(folded, "id", "left").withColumns({
        "device_name": F.coalesce("_device_name", "device_name"),
        "device_type": F.coalesce("_device_type", "device_type"),
        "updated_at": F.when(F.col("_patched"), utc_literal(batch_ts)).otherwise(F.col("updated_at")),
    }).select(*devices.columns))


def delete_outcome(deletes: DataFrame, devices: DataFrame, readings: DataFrame) -> DataFrame:
    """Adds ``outcome``: unknown ids, and ids deleted earlier in the batch, are not found.

    A device with readings cannot be deleted.
    """
    used = _devices_with_readings(deletes, readings).withColumn("_used", F.lit(True))
    # One join per delete row, so that AQE may split the partition of an id that many rows name.
    status = devices.select("id", F.lit(True).alias("_found")).join(used, "id", "left")
    marked = mark_first(deletes, "id", ORDER).join(status, "id", "left")
    return marked.withColumn(
        "outcome",
        F.when(F.col("_found").isNull(), DEVICE_NOT_FOUND)
        .when(F.col("_used"), DEVICE_HAS_READINGS)
        .when(F.col("is_first"), DELETED)
        .otherwise(DEVICE_NOT_FOUND),
    ).drop("_found", "_used", "is_first")


def delete_devices(deletes: DataFrame, devices: DataFrame, readings: DataFrame) -> DataFrame:
    """The next snapshot, without the deleted devices."""
    asked = deletes.select("id").distinct()
    gone = asked.join(_devices_with_readings(deletes, readings), "id", "left_anti")
    return devices.join(gone, "id", "left_anti")


def _devices_with_readings(deletes: DataFrame, readings: DataFrame) -> DataFrame:
    """Ids to delete that have readings. A task sends one row per device, however many readings it saw."""
    return (readings.select(F.col("device_id").alias("id")).distinct()
            .join(deletes.select("id"), "id", "left_semi"))


# -- registrations, patches and deletions in one ordered batch -----------------------------------------

def change_outcome(changes: DataFrame, devices: DataFrame, readings: DataFrame) -> DataFrame:
    """Adds ``outcome`` to ``changes`` (schemas.DEVICE_CHANGE) as if they were applied one after the other.

    Whether a device exists before a change is decided by the last change that made or removed it, whatever came before that: a valid
    registration leaves it there, a deletion removes it unless it has readings. So one look at the last such change replaces a fold over all.
    A change without an id is a registration that fails its checks, or an unknown device.
    """
    used = _devices_with_readings(changes.where(F.col("kind") == DELETE), readings).withColumn("_used", F.lit(True))
    found = devices.select("id", F.lit(True).alias("_found")).join(used, "id", "full")
    checked = validate_devices(changes).join(found, "id", "left")
    there = (F.when((F.col("kind") == REGISTER) & (F.size("violations") == 0), F.lit(True))
             .when((F.col("kind") == DELETE) & F.col("_used").isNull(), F.lit(False)))
    known = last_before(checked.withColumn("_there", there), ["id"], ORDER, "_there", "_before")
    exists = F.coalesce("_before", "_found", F.lit(False))
    outcome = (
        F.when(F.col("kind") == REGISTER, F.when(F.size("violations") > 0, INVALID).when(exists, DEVICE_ALREADY_EXISTS).otherwise(REGISTERED))
        .when(F.col("kind") == PATCH, F.coalesce(patch_error(exists), F.lit(UPDATED)))
        .when(F.col("kind") == DELETE, F.when(~exists, DEVICE_NOT_FOUND).when(F.col("_used"), DEVICE_HAS_READINGS).otherwise(DELETED))
        .otherwise(INVALID))
    return known.withColumn("outcome", outcome).select(*changes.columns, "outcome")


def changed_devices(judged: DataFrame, devices: DataFrame, batch_ts: datetime) -> DataFrame:
    """The devices that a judged batch changed, as they are after it, and ``deleted``; a device that was made and removed is deleted, too.

    Everything comes from the last row of each kind per device, so a task sends one row per device, however many changes it read.
    """
    order = F.struct(*ORDER)
    made, patched, removed = (F.col("outcome") == kind for kind in (REGISTERED, UPDATED, DELETED))
    fields = F.struct("device_name", "device_type", "site", F.struct("latitude", "longitude").alias("location"))
    last = judged.where(made | patched | removed).groupBy("id").agg(
        F.max(F.when(made, order)).alias("_made"), F.max(F.when(removed, order)).alias("_removed"), F.max(F.when(patched, order)).alias("_patched"),
        F.max_by(F.when(made, fields), F.when(made, order)).alias("_new"),
        *(part for name in ("device_name", "device_type") for part in (
            F.max_by(F.when(patched, F.col(name)), F.when(patched & F.col(name).isNotNull(), order)).alias(f"_{name}"),
            F.max(F.when(patched & F.col(name).isNotNull(), order)).alias(f"_{name}_at"))))
    rows = last.join(devices, "id", "left")
    fresh = F.col("_made").isNotNull()
    since = lambda at: ~fresh | (F.col(at) > F.col("_made"))  # noqa: E731  patches before the last registration are gone with its predecessor
    at = utc_literal(batch_ts)
    columns = {name: F.when(fresh, F.col("_new")[name]).otherwise(F.col(name)) for name in ("device_name", "device_type", "site", "location")}
    for name in ("device_name", "device_type"):
        columns[name] = F.when(F.col(f"_{name}_at").isNotNull() & since(f"_{name}_at"), F.col(f"_{name}")).otherwise(columns[name])
    columns["created_at"] = F.when(fresh, at).otherwise(F.col("created_at"))
    columns["updated_at"] = F.when(fresh | F.col("_patched").isNotNull(), at).otherwise(F.col("updated_at"))
    gone = F.col("_removed").isNotNull() & (~fresh | (F.col("_removed") > F.col("_made")))
    return rows.select("id", *(column.alias(name) for name, column in columns.items()), gone.alias("deleted"))


def apply_changes(changes: DataFrame, devices: DataFrame, readings: DataFrame, batch_ts: datetime) -> DataFrame:
    """The next snapshot after a batch of mixed changes."""
    changed = changed_devices(change_outcome(changes, devices, readings), devices, batch_ts)
    return merged_devices(devices, changed)


def merged_devices(devices: DataFrame, changed: DataFrame) -> DataFrame:
    """A snapshot with the rows of ``changed`` in place of its own."""
    kept = devices.join(changed.select("id"), "id", "left_anti")
    return kept.unionByName(changed.where("not deleted").select(*devices.columns))
