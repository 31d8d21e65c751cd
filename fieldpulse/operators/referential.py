"""Checks and lookups against the device table.

No broadcast is forced here. Catalyst broadcasts the device ids while their size is below
``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks the real size at run time, and beyond it the join
is a sort-merge join whose skewed partitions (one hot device) AQE splits. Within a plan that has state AQE is
off; ``flag_known_devices`` can salt the join there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ids(devices: DataFrame) -> DataFrame:
    return devices.select(F.col("id").alias("device_id"))


def known_device_readings(readings: DataFrame, devices: DataFrame) -> DataFrame:
    return readings.join(_ids(devices), "device_id", "left_semi")


def unknown_device_readings(readings: DataFrame, devices: DataFrame) -> DataFrame:
    return readings.join(_ids(devices), "device_id", "left_anti")


def flag_known_devices(readings: DataFrame, devices: DataFrame, salts: int = 1) -> DataFrame:
    """All readings, with ``device_known``. Device ids are unique, so no row is multiplied.

    ``salts`` above 1 deals the readings of a device over so many join keys, each with its own copy of the id, where AQE
    cannot split a hot device, as within a plan that has state.
    """
    flagged, on = _ids(devices).withColumn("_known", F.lit(True)), ["device_id"]
    if salts > 1:
        flagged = flagged.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        readings = readings.withColumn("_salt", F.pmod(F.xxhash64("idempotency_key", "ingested_at", "delivery_seq"), F.lit(salts)).cast("int"))
        on = ["device_id", "_salt"]
    return (readings.join(flagged, on, "left")
            .withColumn("device_known", F.coalesce("_known", F.lit(False)))
            .drop("_known", "_salt"))


def existence(devices: DataFrame, states: DataFrame) -> DataFrame:
    """Per device id whether the snapshot has it, and in order the later times at which it came (``there``) or went.

    ``states(id, received_at, seq, there)`` has a row per registration and deletion that took place; those of a device meet in one row.
    """
    later = states.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("received_at", "seq", "there"))).alias("states"))
    return (devices.select("id", F.lit(True).alias("_held")).join(later, "id", "full")
            .select("id", F.coalesce("_held", F.lit(False)).alias("held"), "states"))


def flag_known_at_arrival(readings: DataFrame, known: DataFrame) -> DataFrame:
    """All readings, with ``device_known``: whether the device was there when the reading arrived. ``known`` is from ``existence``; a change at the very
    time of arrival counts. A reading without an arrival time is judged by the snapshot."""
    past = F.filter("states", lambda state: state["received_at"] <= F.col("ingested_at"))
    flagged = known.withColumnRenamed("id", "device_id")
    there = F.coalesce(F.get(past, F.size(past) - 1)["there"], F.col("held"), F.lit(False))
    return readings.join(flagged, "device_id", "left").withColumn("device_known", there).drop("held", "states")


def reading_with_device(readings: DataFrame, devices: DataFrame) -> DataFrame:
    return readings.join(devices.withColumnRenamed("id", "device_id"), "device_id")
