"""Column layouts of the frames that pass between operators.

Times are TIMESTAMP_NTZ holding UTC: parquet keeps min/max statistics for them and no session zone can
shift them.
"""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("delivery_seq", T.LongType()),
])

# JSON body of a reading message; recordedAt is optional.
READING_PAYLOAD = T.StructType([
    T.StructField("metricType", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("recordedAt", T.TimestampType()),
    T.StructField("idempotencyKey", T.StringType()),
])

READING_REQUEST = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
    T.StructField("idempotency_key", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("delivery_seq", T.LongType()),
])

READING = READING_REQUEST

DEVICE_REQUEST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("received_at", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

DEVICE_PATCH = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("received_at", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

# One change of a device; kind says which fields count.
DEVICE_CHANGE = T.StructType([T.StructField("kind", T.StringType()), *DEVICE_REQUEST.fields])

LOCATION = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

DEVICE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

WINDOW_METRICS = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("average", T.DoubleType()),
    T.StructField("p95", T.DoubleType()),
    T.StructField("count", T.LongType()),
])
