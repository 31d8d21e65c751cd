"""Telemetry frames out of the general tables ``events``, ``customer`` and ``nation``.

The expressions are fixed, so that SQL can state the same rows. Some rows are spoiled on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN_DEVICE = 3  # c_custkey % 10 of the customers left out of the device table
REDELIVERED_EVERY = 20
SPOILED_EVERY = 50
PAYLOAD_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(count: Column) -> Column:
    return F.make_dt_interval(secs=count)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrival = F.col("ts") + _seconds((F.col("event_id") * 37) % 120)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("dev-"), F.col("user_id")).alias("device_id"),
        F.col("event_type").alias("metric_type"),
        "value",
        F.col("ts").alias("recorded_at"),
        arrival.alias("ingested_at"),
        F.concat(F.lit("evt-"), F.col("event_id")).alias("idempotency_key"),
        (F.col("event_id") * 2).alias("delivery_seq"),
    )


def _event_id() -> Column:
    return F.expr("delivery_seq div 2")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and their redelivered copies, from one scan; copies differ in value and come later."""
    copies = F.when(_event_id() % REDELIVERED_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    copy = F.col("copy")
    return readings(spark, sf_dir).withColumn("copy", F.explode(copies)).withColumns({
        "value": F.col("value") + copy * 1000,
        "ingested_at": F.col("ingested_at") + _seconds(copy * 30),
        "delivery_seq": F.col("delivery_seq") + copy,
    }).drop("copy")


def as_messages(rows: DataFrame) -> DataFrame:
    """Deliveries as messages; every fiftieth payload lacks its last character."""
    payload = F.to_json(F.struct(
        F.col("metric_type").alias("metricType"),
        "value",
        F.date_format("recorded_at", PAYLOAD_TIME).alias("recordedAt"),
        F.col("idempotency_key").alias("idempotencyKey"),
    ))
    spoiled = (_event_id() % SPOILED_EVERY == 1).cast("int")
    kept = F.length("payload") - spoiled
    return rows.withColumns({
        "topic": F.concat(F.lit("devices/"), F.col("device_id"), F.lit("/readings")),
        "payload": payload,
    }).select(
        "topic",
        F.substr("payload", F.lit(1), kept).alias("payload"),
        "ingested_at",
        "delivery_seq",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(deliveries(spark, sf_dir))


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in the layout of Spark's Kafka source."""
    return messages(spark, sf_dir).select(
        F.col("topic").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        F.lit("readings").alias("topic"),
        (F.col("delivery_seq") % 4).cast("int").alias("partition"),
        F.expr("delivery_seq div 4").alias("offset"),
        F.col("ingested_at").cast("timestamp").alias("timestamp"),
    )


def stray_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some have a topic the subscription does not cover."""
    event_id = _event_id()
    level = F.element_at(F.split("topic", "/"), 2)
    return messages(spark, sf_dir).withColumn(
        "topic",
        F.when(event_id % 7 == 0, F.concat(F.lit("devices/"), level, F.lit("/a/readings")))
        .when(event_id % 7 == 1, F.concat(F.lit("devices/"), level, F.lit("/status")))
        .when(event_id % 7 == 2, level)
        .when(event_id % 7 == 3, F.lit("devices//readings"))
        .otherwise(F.col("topic")))


def faulty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as direct requests, with broken fields, and some without a recorded time."""
    event_id = _event_id()
    return deliveries(spark, sf_dir).withColumns({
        "metric_type": F.when(event_id % 11 == 0, F.lit("\t "))
        .when(event_id % 11 == 1, F.repeat(F.lit("m"), F.lit(33)))
        .when(event_id % 11 == 2, F.repeat(F.lit(" "), F.lit(33)))
        .when(event_id % 11 == 3, F.repeat(F.lit("m"), F.lit(32)))
        .otherwise(F.col("metric_type")),
        "value": F.when(event_id % 13 != 0, F.col("value")),
        "recorded_at": F.when(event_id % 17 != 0, F.col("recorded_at")),
        "idempotency_key": F.when(event_id % 19 == 0, F.lit("")).when(
            event_id % 19 != 1, F.col("idempotency_key")),
    })


def device_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the registered devices."""
    return table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != UNKNOWN_DEVICE).select(
        F.concat(F.lit("dev-"), F.col("c_custkey")).alias("id"))


def device_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration rows for all customers; some have a bad type or latitude, some ids come twice."""
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    device_type = (F.when(segment == "BUILDING", "GATEWAY").when(segment == "AUTOMOBILE", "CAMERA")
                   .when(segment == "MACHINERY", "SENSOR").when(segment == "FURNITURE", "EDGE_NODE")
                   .otherwise(segment))
    again = F.explode(F.when(key % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("again", again)
            .select(
                F.concat(F.lit("dev-"), key).alias("id"),
                F.when(F.col("again") == 1, F.lit("again")).otherwise(F.col("c_name")).alias("device_name"),
                device_type.alias("device_type"),
                F.col("n_name").alias("site"),
                ((key * 7) % 200 - 100).cast("double").alias("latitude"),
                ((key * 13) % 360 - 180).cast("double").alias("longitude"),
                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("received_at"),
                (key * 2 + F.col("again")).alias("seq"),
            ))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device snapshot: one row per registered customer."""
    created = F.lit("2023-12-01 00:00:00").cast("timestamp_ntz")
    return (device_requests(spark, sf_dir)
            .where((F.col("seq") % 2 == 0) & (F.expr("seq div 2") % 10 != UNKNOWN_DEVICE))
            .select("id", "device_name", "device_type", "site",
                    F.struct("latitude", "longitude").alias("location"),
                    created.alias("created_at"), created.alias("updated_at")))


def device_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches for all customers, of several kinds, three for some of them."""
    key = F.col("c_custkey")
    nth = F.col("nth")
    kind = (key + nth) % 7
    patches = F.explode(F.when(key % 4 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(0))))
    return table(spark, sf_dir, "customer").withColumn("nth", patches).select(
        F.concat(F.lit("dev-"), key).alias("id"),
        F.when(kind == 0, F.concat(F.lit("name-"), nth)).when(kind == 1, F.lit("   "))
        .when(kind == 2, F.repeat(F.lit("n"), F.lit(129)))
        .when(kind == 3, F.concat(F.lit("both-"), nth)).alias("device_name"),
        F.when(kind == 3, F.lit("CAMERA")).when(kind == 4, F.lit("SENSOR"))
        .when(kind == 5, F.lit("TOASTER")).alias("device_type"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("received_at"),
        (key * 3 + nth).alias("seq"),
    )


def device_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete rows for all customers, two for some of them."""
    key = F.col("c_custkey")
    nth = F.explode(F.when(key % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return table(spark, sf_dir, "customer").withColumn("nth", nth).select(
        F.concat(F.lit("dev-"), key).alias("id"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("received_at"),
        (key * 2 + F.col("nth")).alias("seq"),
    )


def device_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight changes per customer, of all kinds, in an order of their own; rows of schemas.DEVICE_CHANGE."""
    key, nth = F.col("c_custkey"), F.col("nth")
    kind = (key + nth * 5 + F.expr("c_custkey div 7")) % 5
    return table(spark, sf_dir, "customer").withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(7)))).select(
        F.when(kind < 2, "REGISTER").when(kind < 4, "PATCH").otherwise("DELETE").alias("kind"),
        F.concat(F.lit("dev-"), key).alias("id"),
        F.when((key + nth) % 11 != 0, F.concat(F.lit("name-"), nth)).alias("device_name"),
        F.when((key + nth) % 13 != 0, F.when(kind == 3, "CAMERA").when(kind < 3, "SENSOR")).alias("device_type"),
        F.lit("site").alias("site"), F.lit(1.5).alias("latitude"), nth.cast("double").alias("longitude"),
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + _seconds((key * 13 + nth * 29) % 60)).alias("received_at"),
        (key * 8 + nth).cast("long").alias("seq"))


def some_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth reading."""
    return readings(spark, sf_dir).where(_event_id() % 50 == 0)


def late_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that the device table leaves out register one after the other, and half of them twice; rows of schemas.DEVICE_CHANGE."""
    key, nth = F.col("c_custkey"), F.col("nth")
    rows = table(spark, sf_dir, "customer").where(key % 10 == UNKNOWN_DEVICE)
    return rows.withColumn("nth", F.explode(F.sequence(F.lit(0), F.expr("cast(c_custkey % 20 = 13 as int)")))).select(
        F.lit("REGISTER").alias("kind"), F.concat(F.lit("dev-"), key).alias("id"), F.concat(F.lit("late-"), nth).alias("device_name"),
        F.lit("SENSOR").alias("device_type"), F.lit("site").alias("site"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        (F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") + _seconds((key * 7919 + nth * 100_000) % 2_000_000)).alias("received_at"),
        (key * 2 + nth).cast("long").alias("seq"))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters of all kinds, one or two per nation; some overlap and some are not valid."""
    key = F.col("n_nationkey")
    device = F.concat(F.lit("devices/dev-"), key)
    kind = (F.when(key % 6 == 0, F.array(F.lit("devices/+/readings"), F.concat(device, F.lit("/#"))))
            .when(key % 6 == 1, F.array(F.concat(device, F.lit("/#")))).when(key % 6 == 2, F.array(F.lit("+/+/a/+"), F.lit("devices/#/x")))
            .when(key % 6 == 3, F.array(F.lit("devices/+/+/#"))).when(key % 6 == 4, F.array(F.concat(device, F.lit("/readings")), F.lit("dev+/#")))
            .otherwise(F.array(F.lit("+"), F.lit("devices//readings"))))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("subscription"), F.explode(kind).alias("topic_filter"))
