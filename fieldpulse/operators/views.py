"""Output projections and the location value object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def location_pack(devices: DataFrame) -> DataFrame:
    return (devices.withColumn("location", F.struct("latitude", "longitude"))
            .drop("latitude", "longitude"))


def location_flatten(devices: DataFrame) -> DataFrame:
    return devices.withColumns({
        "latitude": F.col("location.latitude"),
        "longitude": F.col("location.longitude"),
    }).drop("location")


def reading_view(readings: DataFrame) -> DataFrame:
    """A reading with both of its times and the lag between them."""
    lag = F.col("ingested_at") - F.col("recorded_at")
    return readings.select("device_id", "metric_type", "value", "recorded_at", "ingested_at",
                           lag.alias("lag"))


def device_view(devices: DataFrame) -> DataFrame:
    return location_flatten(devices).select("id", "device_name", "device_type", "site", "latitude",
                                            "longitude", "created_at", "updated_at")


def reading_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("device_id").agg(F.count(F.lit(1)).alias("reading_count"))
