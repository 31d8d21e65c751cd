"""Reading messages and change rows from files and from Kafka, in batch and in streaming.

Every reader takes one schema for both modes, and none infers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.times import utc_ntz
from fieldpulse.operators.decode import TOPIC_PATTERN, topic_match
from fieldpulse.schemas import DEVICE_PATCH, DEVICE_REQUEST, MESSAGE, READING_REQUEST

# Times in files carry microseconds; the default of the JSON writer cuts them to milliseconds.
CORRUPT_LINE = "_corrupt_line"
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, streaming: bool,
          max_files: int | None) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(schema)
    if fmt == "json":
        reader = reader.options(columnNameOfCorruptRecord=CORRUPT_LINE, **JSON_TIMES)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def reading_messages(spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False,
                     max_files: int | None = None) -> DataFrame:
    """Captured messages of the subscription. ``max_files`` bounds the intake of one micro-batch.

    A capture line that is not a whole message, as a cut one, stays as a message without topic whose payload is
    the line, so it is counted among the unreadable ones.
    """
    if fmt != "json":
        return topic_match(_read(spark, path, MESSAGE, fmt, streaming, max_files))
    lines = _read(spark, path, T.StructType([*MESSAGE.fields, T.StructField(CORRUPT_LINE, T.StringType())]), fmt, streaming, max_files)
    cut = F.col(CORRUPT_LINE).isNotNull()
    return lines.where(cut | F.col("topic").rlike(TOPIC_PATTERN)).select(
        F.when(~cut, F.col("topic")).alias("topic"), F.coalesce(CORRUPT_LINE, "payload").alias("payload"),
        *[F.when(~cut, F.col(name)).alias(name) for name in MESSAGE.names[2:]])


def reading_requests(spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False,
                     max_files: int | None = None) -> DataFrame:
    return _read(spark, path, READING_REQUEST, fmt, streaming, max_files)


def device_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _read(spark, path, DEVICE_REQUEST, fmt, False, None)


def device_patches(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _read(spark, path, DEVICE_PATCH, fmt, False, None)


def kafka_records(spark: SparkSession, servers: str, topics: str, streaming: bool = True,
                  max_offsets: int | None = None) -> DataFrame:
    """Records of a topic that bridges the devices' messages. Needs Spark's Kafka package."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**{
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "earliest",
    })
    if streaming and max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def messages_from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records to messages: the record key is the device topic, the broker's time is the arrival.

    Offsets count per partition, so the partition goes into the low bits to keep ``delivery_seq`` unique.
    """
    return topic_match(records.select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        utc_ntz(F.col("timestamp")).alias("ingested_at"),
        (F.shiftleft("offset", 16) + F.col("partition")).alias("delivery_seq"),
    ))


def ingest_stamp(rows: DataFrame, source_time: str | None = None) -> DataFrame:
    """Adds the arrival time: the source's own time if it has one, else the time of reading.

    A client never supplies it. The time of reading differs between runs, so store the stamped rows before
    anything uses them.
    """
    at = F.col(source_time) if source_time else utc_ntz(F.current_timestamp())
    return rows.withColumn("ingested_at", at)
