"""How many files the key index leaves, whatever its shape."""

from pyspark.sql import functions as F
from telemetry_rows import at

from fieldpulse.streaming.key_index import FILES, IndexShape, KeyIndex


def test_files_of_a_run_are_bounded(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), IndexShape(slot_keys=4, bucket_slots=1, fanout=2))
    keys = spark.range(3000).select(F.concat(F.lit("key-"), "id").alias("idempotency_key"), F.lit(at("00:10")).cast("date").alias("event_date"))
    for batch_id in range(2):
        index.add(keys.where(F.col("id") % 2 == batch_id), batch_id)
    index.merge(2)
    assert [run.level for run in index.runs.live()] == [1]
    for part in ("keys", "filters"):
        folders = list(tmp_path.glob(f"runs/run=l1-0-1/part={part}/bucket=*"))
        assert 100 < len(folders) <= FILES
    asked = spark.createDataFrame([("key-17",), ("key-2999",), ("new",)], "idempotency_key string")
    assert {(row.idempotency_key, row.batch_id) for row in index.seen(asked).collect()} == {("key-17", 1), ("key-2999", 1)}
    assert index.seen(keys).count() == 3000


def test_large_runs_keep_the_shape_of_their_files():
    assert IndexShape().slots_per_file(10_000_000) == 32
    assert IndexShape(slot_keys=256, bucket_slots=2).slots_per_file(500) == 2
    assert IndexShape(slot_keys=256, bucket_slots=2).slots_per_file(10_000_000) == 256
