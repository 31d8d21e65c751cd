"""Reading messages to reading requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.times import utc_ntz
from fieldpulse.schemas import READING_PAYLOAD

# The subscription devices/+/readings and the ISO-8601 instant of a payload.
TOPIC_PATTERN = "^devices/[^/]*/readings$"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"

_CORRUPT = "_corrupt"


def topic_match(messages: DataFrame) -> DataFrame:
    """Messages whose topic the subscription covers; ``+`` stands for exactly one level."""
    return messages.where(F.col("topic").rlike(TOPIC_PATTERN))


def topic_device_id(topic: Column) -> Column:
    """Second level of the topic, or null if there is none."""
    return F.get(F.split(topic, "/"), F.lit(1))


def payload_decode(messages: DataFrame) -> DataFrame:
    """Adds the request fields and ``decode_error``; unreadable rows stay, with null fields.

    A field of the wrong type makes the whole message unreadable; unknown fields are ignored.
    """
    layout = T.StructType([*READING_PAYLOAD.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("payload", layout, {
        "columnNameOfCorruptRecord": _CORRUPT,
        "timestampFormat": INSTANT_FORMAT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    })
    device_id = topic_device_id(F.col("topic"))
    # A generator is evaluated once per row: without it, later filters and fields would each be inlined
    # down to a parse of their own.
    decoded = messages.withColumn("_request", F.explode(F.array(parsed))).withColumns({
        "device_id": device_id,
        "decode_error": F.col("_request").isNull() | F.col(f"_request.{_CORRUPT}").isNotNull()
        | device_id.isNull(),
    })

    def field(name: str) -> Column:
        return F.when(~F.col("decode_error"), F.col(f"_request.{name}"))

    return decoded.select(
        "topic",
        "payload",
        "device_id",
        field("metricType").alias("metric_type"),
        field("value").alias("value"),
        utc_ntz(field("recordedAt")).alias("recorded_at"),
        field("idempotencyKey").alias("idempotency_key"),
        "ingested_at",
        "delivery_seq",
        "decode_error",
    )


def decode_rejects(messages: DataFrame) -> DataFrame:
    """The unreadable messages, as received."""
    return payload_decode(messages).where("decode_error").select(
        "topic", "payload", "ingested_at", "delivery_seq")


def reading_requests(messages: DataFrame) -> DataFrame:
    """The readable messages of the subscription, as requests."""
    return payload_decode(topic_match(messages)).where(~F.col("decode_error")).drop(
        "topic", "payload", "decode_error")


def recorded_at_default(requests: DataFrame) -> DataFrame:
    """A reading without a recorded time counts as recorded on arrival."""
    return requests.withColumn("recorded_at", F.coalesce("recorded_at", "ingested_at"))


def merge_transports(decoded: DataFrame, requests: DataFrame) -> DataFrame:
    """One stream of deliveries out of decoded messages and direct requests."""
    direct = requests.withColumn("decode_error", F.lit(False))
    return decoded.drop("topic", "payload").unionByName(direct)
