"""Steps of the ingest that must not grow faster than their input: same results as the plain way, with fewer shuffles, joins and files."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from telemetry_rows import at

from fieldpulse.functions.text import longer_than
from fieldpulse.functions.times import bin_start
from fieldpulse.operators import dedup, outcome, quantile
from fieldpulse.operators.skew import BATCH_ROWS, HotGroups, tasks_for
from fieldpulse.session import CACHE_SETTINGS, cached
from fieldpulse.streaming.window_counts import WindowCounts

ROW = "idempotency_key string, ingested_at timestamp_ntz, delivery_seq long, value double"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def deliveries_of(spark, seed):
    """Copies, identical rows, unknown keys, arrivals and numbers, and rows that are not storable."""
    draw = random.Random(seed)
    rows = [(draw.choice(["a", "b", "c", "d", "e", "", None]), draw.choice([at("00:10"), at("00:11"), None]), draw.choice([1, 2, None]),
             float(draw.randrange(4))) for _ in range(80)]
    singles = [(f"k{i}", at("00:10"), 5, 1.0) for i in range(40)]
    storable = F.when(F.col("value") < 2, True).when(F.col("value") == 2, False)
    return spark.createDataFrame(rows + singles, ROW).withColumn("storable", storable)


@pytest.mark.parametrize("seed", range(3))
def test_first_by_one_sort_is_first_by_join(spark, seed):
    rows = deliveries_of(spark, seed)
    seen = spark.createDataFrame([("a",), ("k1",), ("k1",), ("unasked",)], "idempotency_key string")
    for stored in (None, seen):
        plain = dedup.mark_first(rows, eligible=F.col("storable"), seen=stored)
        sorted_ = dedup.mark_first(rows, eligible=F.col("storable"), seen=stored, hot=HotGroups())
        assert sorted_.columns == plain.columns
        assert sorted(map(str, sorted_.collect())) == sorted(map(str, plain.collect()))
        assert "Join" not in plan(sorted_)


def test_a_hot_key_takes_the_join(spark):
    rows = spark.range(50).select(F.lit("hot").alias("idempotency_key"), F.lit(at("00:10")).alias("ingested_at"), F.col("id").alias("delivery_seq"))
    marked = dedup.mark_first(rows, hot=HotGroups(min_rows=10))
    assert "Join" in plan(marked)
    assert [row.delivery_seq for row in marked.where("is_first").collect()] == [0]


def test_checked_rows_without_their_message(deliveries, devices):
    rows = deliveries(("a", "00:10", "00:11", 1.0), ("a", "00:10", "00:11", 2.0), ("b", "00:10", "00:12", 1.0)).withColumns(
        {"decode_error": F.lit(False), "delivery_seq": F.lit(7).cast("long"), "topic": F.lit("t"), "payload": F.concat(F.lit("p"), "value")})
    whole, slim = (outcome.check_deliveries(rows, devices("d1"), message=message) for message in (True, False))
    assert set(whole.columns) - set(slim.columns) == {"topic", "payload"}
    labels = [sorted((row.idempotency_key, row.value, row.outcome) for row in outcome.label_outcomes(checked, hot=HotGroups()).collect()) for checked in (whole, slim)]
    assert labels[0] == labels[1]


def test_own_counts_of_a_batch_are_not_joined(spark, tmp_path):
    counts = WindowCounts(spark, str(tmp_path))

    def touched(batch_id, *minutes):
        made = [("d", "m", at("00:00") + timedelta(minutes=minute), float(minute), at("00:00") + timedelta(minutes=minute)) for minute in minutes]
        rows = spark.createDataFrame(made, "device_id string, metric_type string, window_start timestamp_ntz, value double, ingested_at timestamp_ntz")
        counts.add(rows, batch_id)
        return counts.touched(rows.select("device_id", "metric_type", "window_start").distinct(), batch_id)
    first = touched(0, 0, 1, 1)
    assert "Join" not in plan(first) and sorted(row["count"] for row in first.collect()) == [1, 2]
    assert sorted((row.window_start.minute, row["count"]) for row in touched(1, 1, 2).collect()) == [(1, 3), (2, 1)]


def test_counts_without_a_device_have_no_metrics(spark, tmp_path):
    counts = WindowCounts(spark, str(tmp_path))
    rows = spark.createDataFrame([(device, "m", at("00:00"), 1.0, at("00:00")) for device in ("d", None)],
                                 "device_id string, metric_type string, window_start timestamp_ntz, value double, ingested_at timestamp_ntz")
    counts.add(rows, 0)
    assert [row.device_id for row in counts.touched(rows.select("device_id", "metric_type", "window_start").distinct(), 0).collect()] == ["d"]


def test_weighted_stats_take_one_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") % 11).cast("double").alias("value"), F.lit(2).alias("n"))
    stats = quantile.group_stats(rows, ["g"], hot=None, weight="n")
    stats.collect()
    assert plan(stats).split("Initial Plan")[0].count("Exchange") == 1
    assert sum(row["count"] for row in stats.collect()) == 2000


@pytest.mark.parametrize("text, longer", [("m" * 32, False), ("m" * 33, True), ("\u00e9" * 32, False), ("\u00e9" * 33, True), ("\U0001f600" * 16, False),
                                          ("\U0001f600" * 17, True), ("", False), (None, False)])
def test_length_in_utf16_units(spark, text, longer):
    assert spark.createDataFrame([(text,)], "t string").select(longer_than(F.col("t"), 32)).first()[0] is longer


def test_cached_rows_are_made_at_once_and_not_encoded(spark, monkeypatch):
    before = {name: spark.conf.get(name) for name in CACHE_SETTINGS}
    rows, under = spark.range(1000).select((F.col("id") * 3).alias("n")).repartition(2), []
    count = type(rows).count
    monkeypatch.setattr(type(rows), "count", lambda self: under.append({name: spark.conf.get(name) for name in CACHE_SETTINGS}) or count(self))
    held = {info.id() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    rows = cached(rows)
    try:
        assert any(info.numCachedPartitions() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo() if info.id() not in held)
        assert under == [CACHE_SETTINGS] and CACHE_SETTINGS["spark.sql.inMemoryColumnarStorage.compressed"] == "false"
        assert rows.agg(F.sum("n")).first()[0] == 3 * sum(range(1000))
    finally:
        rows.unpersist(True)
    assert {name: spark.conf.get(name) for name in CACHE_SETTINGS} == before


def test_rows_that_cannot_be_made_are_not_kept(spark):
    rows = spark.range(10).select(F.raise_error(F.lit("broken")).cast("long").alias("n"), "id").where("id >= 0")
    before = {name: spark.conf.get(name) for name in CACHE_SETTINGS}
    with pytest.raises(Exception, match="broken"):
        cached(rows.where(F.col("n").isNull()))
    assert not rows.where(F.col("n").isNull()).is_cached and {name: spark.conf.get(name) for name in CACHE_SETTINGS} == before


def test_tasks_of_a_batch(spark):
    cores = spark.sparkContext.defaultParallelism
    assert tasks_for(spark, 360 * BATCH_ROWS, BATCH_ROWS) == max(360, cores)
    assert tasks_for(spark, 0, BATCH_ROWS) == 1 and tasks_for(spark, BATCH_ROWS, BATCH_ROWS) == min(cores, BATCH_ROWS // 8_192)
    # A shuffle from the labelled rows opens a file per task and partition.
    assert tasks_for(spark, 36_000_000, BATCH_ROWS) * 4 <= tasks_for(spark, 36_000_000) + 4


@pytest.mark.parametrize("size", [timedelta(minutes=1), timedelta(days=1), timedelta(seconds=7, microseconds=3)])
def test_start_of_a_bin_in_whole_numbers(spark, size):
    epoch = datetime(1970, 1, 1)
    times = [datetime(2024, 1, 31, 23, 59, 59, 999_999), datetime(2024, 2, 1), datetime(1969, 12, 31, 23, 59, 59, 1), datetime(1583, 5, 4, 3, 2, 1, 7), None]
    starts = spark.createDataFrame([(time,) for time in times], "at timestamp_ntz").select("at", bin_start(F.col("at"), size).alias("start"))
    assert [row.start for row in starts.collect()] == [time and epoch + (time - epoch) // size * size for time in times]
    assert "decimal" not in plan(starts)
