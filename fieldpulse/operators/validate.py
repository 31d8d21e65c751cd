"""Request validation: one ``violations`` array per row, empty when the row is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.text import is_blank, is_unicode_blank, longer_than

# Limits, device types, messages and error codes.
METRIC_TYPE_LENGTH = 32
DEVICE_ID_LENGTH = 64
DEVICE_NAME_LENGTH = 128
LATITUDE_LIMIT = 90.0
LONGITUDE_LIMIT = 180.0
DEVICE_TYPES = ("CAMERA", "GATEWAY", "SENSOR", "EDGE_NODE")
NOT_BLANK = "must not be blank"
NOT_NULL = "must not be null"
SIZE = "size must be between 0 and {limit}"
AT_LEAST = "must be greater than or equal to {limit}"
AT_MOST = "must be less than or equal to {limit}"
ONE_OF = "must be one of {values}"
NO_FIELDS_TO_UPDATE = "NO_FIELDS_TO_UPDATE"
DEVICE_NOT_FOUND = "DEVICE_NOT_FOUND"
DEVICE_NAME_CANNOT_BE_BLANK = "DEVICE_NAME_CANNOT_BE_BLANK"
INVALID = "INVALID"


def _violations(*rules: tuple[Column, str, str]) -> Column:
    found = F.array(*[
        F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(message).alias("message")))
        for broken, field, message in rules
    ])
    return F.filter(found, lambda entry: entry.isNotNull())


def device_type_known(device_type: Column) -> Column:
    return device_type.isin(*DEVICE_TYPES)


def _outside(value: Column, limit: float, field: str) -> list[tuple[Column, str, str]]:
    return [
        (value.isNull(), field, NOT_NULL),
        (value < -limit, field, AT_LEAST.format(limit=-limit)),
        (value > limit, field, AT_MOST.format(limit=limit)),
    ]


def validate_readings(requests: DataFrame) -> DataFrame:
    metric, key = F.col("metric_type"), F.col("idempotency_key")
    return requests.withColumn("violations", _violations(
        (is_blank(metric), "metricType", NOT_BLANK),
        (longer_than(metric, METRIC_TYPE_LENGTH), "metricType", SIZE.format(limit=METRIC_TYPE_LENGTH)),
        (F.col("value").isNull(), "value", NOT_NULL),
        (is_blank(key), "idempotencyKey", NOT_BLANK),
    ))


def validate_devices(requests: DataFrame) -> DataFrame:
    device_type = F.col("device_type")
    return requests.withColumn("violations", _violations(
        (is_blank(F.col("id")), "id", NOT_BLANK),
        (longer_than(F.col("id"), DEVICE_ID_LENGTH), "id", SIZE.format(limit=DEVICE_ID_LENGTH)),
        (is_blank(F.col("device_name")), "deviceName", NOT_BLANK),
        (longer_than(F.col("device_name"), DEVICE_NAME_LENGTH), "deviceName",
         SIZE.format(limit=DEVICE_NAME_LENGTH)),
        (device_type.isNull(), "deviceType", NOT_NULL),
        (~device_type_known(device_type), "deviceType", ONE_OF.format(values=", ".join(DEVICE_TYPES))),
        (is_blank(F.col("site")), "site", NOT_BLANK),
        *_outside(F.col("latitude"), LATITUDE_LIMIT, "latitude"),
        *_outside(F.col("longitude"), LONGITUDE_LIMIT, "longitude"),
    ))


def valid(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("violations") == 0)


def violation_list(rows: DataFrame, row_key: str) -> DataFrame:
    """One row per violation; two on the same field are both kept."""
    return rows.select(F.col(row_key).alias("row_key"), F.inline("violations"))


def patch_error(device_found: Column) -> Column:
    """The first failing check of a device patch, or null: shape, no fields, unknown device, blank name."""
    name, device_type = F.col("device_name"), F.col("device_type")
    malformed = longer_than(name, DEVICE_NAME_LENGTH) | F.coalesce(
        ~device_type_known(device_type), F.lit(False))
    return (
        F.when(malformed, INVALID)
        .when(name.isNull() & device_type.isNull(), NO_FIELDS_TO_UPDATE)
        .when(~device_found, DEVICE_NOT_FOUND)
        .when(is_unicode_blank(name), DEVICE_NAME_CANNOT_BE_BLANK)
    )
