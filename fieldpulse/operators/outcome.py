"""One label per delivered row, in stage order.

decode, then validate, then device check, then first delivery of its key, then lateness. Only rows that
pass the device check use up their key; a row dropped as too late is stored and has used its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.operators.decode import recorded_at_default
from fieldpulse.operators.dedup import mark_first, without_message
from fieldpulse.operators.referential import flag_known_at_arrival, flag_known_devices
from fieldpulse.operators.skew import HotGroups
from fieldpulse.operators.validate import validate_readings
from fieldpulse.operators.windows import (
    DEFAULT_POLICY, LATE_ACCEPTED, LATE_DROPPED, WindowPolicy, late_by, lateness_class,
)

# Fixed values.
DECODE_ERROR = "DECODE_ERROR"
INVALID = "INVALID"
DEVICE_NOT_FOUND = "DEVICE_NOT_FOUND"
DUPLICATE = "DUPLICATE"
DROPPED_LATE = "DROPPED_LATE"
ACCEPTED_LATE = "ACCEPTED_LATE"
ACCEPTED = "ACCEPTED"

STORED = (ACCEPTED, ACCEPTED_LATE, DROPPED_LATE)
COUNTED = (ACCEPTED, ACCEPTED_LATE)
REJECTED = (DECODE_ERROR, INVALID, DEVICE_NOT_FOUND)


def check_deliveries(deliveries: DataFrame, devices: DataFrame, salts: int = 1, message: bool = True) -> DataFrame:
    """The stages that look at one row and the device table: defaults, violations, device, lateness.

    ``deliveries`` holds the request columns and ``decode_error``. ``devices`` has an id per device, or is from ``referential.existence``; then a
    device must have been there when the reading arrived. No ``message`` leaves out the text that deliveries were decoded from, before the join.
    """
    checks = validate_readings(recorded_at_default(deliveries))
    checks = checks if message else without_message(checks)
    checked = flag_known_at_arrival(checks, devices) if "states" in devices.columns else flag_known_devices(checks, devices, salts)
    return checked.withColumn(
        "storable",
        ~F.col("decode_error") & (F.size("violations") == 0) & F.col("ingested_at").isNotNull() & F.col("device_known"))


def rejection() -> Column:
    """Why a checked delivery is not storable; null if it is."""
    return (F.when(F.col("decode_error"), DECODE_ERROR)
            .when((F.size("violations") > 0) | F.col("ingested_at").isNull(), INVALID)
            .when(~F.col("device_known"), DEVICE_NOT_FOUND))


def label_outcomes(checked: DataFrame, seen: DataFrame | None = None,
                   policy: WindowPolicy = DEFAULT_POLICY, hot: HotGroups | None = None) -> DataFrame:
    """Labels checked deliveries. ``seen`` holds the keys stored before them; ``hot`` is for ``mark_first``, if they are stored or cached."""
    marked = mark_first(checked, eligible=F.col("storable"), seen=seen, hot=hot)
    outcome = (
        F.when(~F.col("storable"), rejection())
        .when(~F.col("is_first"), DUPLICATE)
        .when(F.col("lateness") == LATE_DROPPED, DROPPED_LATE)
        .when(F.col("lateness") == LATE_ACCEPTED, ACCEPTED_LATE)
        .otherwise(ACCEPTED)
    )
    return (late_by(lateness_class(marked, policy)).withColumn("outcome", outcome)
            .drop("is_first", "lateness", "storable", "device_known", "_content"))


def ingest_outcome(deliveries: DataFrame, devices: DataFrame, seen: DataFrame | None = None,
                   policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
    return label_outcomes(check_deliveries(deliveries, devices), seen, policy)


def stored_rows(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("outcome").isin(*STORED))


def counted_rows(labelled: DataFrame) -> DataFrame:
    """Rows that count in their window."""
    return labelled.where(F.col("outcome").isin(*COUNTED))


def rejected_rows(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("outcome").isin(*REJECTED))


def outcome_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
