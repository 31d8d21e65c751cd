"""The key index against a plain set of keys, and what it reads."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldpulse.streaming.key_index import IndexShape, KeyIndex, dedup_against_index

DAY = date(2026, 9, 25)


def keys(spark, names):
    return spark.createDataFrame([(name, DAY) for name in names], "idempotency_key string, event_date date")


def held(index, names, batch_id=None):
    return {(row.idempotency_key, row.batch_id) for row in index.seen(keys(index.spark, names), batch_id).collect()}


@pytest.mark.parametrize("shape", [IndexShape(), IndexShape(slot_keys=4, bucket_slots=2, fanout=2)])
def test_seen_keys_over_batches_and_merges(spark, tmp_path, shape):
    index, draw, stored = KeyIndex(spark, str(tmp_path), shape), random.Random(1), {}
    assert held(index, ["k1"]) == set()
    for batch_id in range(7):
        fresh = [f"k{batch_id}-{i}" for i in range(draw.randrange(0, 40))]
        index.add(keys(spark, fresh), batch_id)
        stored |= {name: batch_id for name in fresh}
        index.merge(batch_id)
        asked = draw.sample(sorted(stored), min(len(stored), 20)) + ["new-1", "new-2", "", None]
        assert held(index, asked) == {(name, stored[name]) for name in asked if name in stored}
        assert held(index, asked, batch_id) == {(name, stored[name]) for name in asked if stored.get(name, batch_id) != batch_id}
    if shape.fanout == 2:
        assert len(index.runs.live()) <= 4 and max(run.level for run in index.runs.live()) >= 2


def test_a_batch_run_again_replaces_its_run(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path))
    index.add(keys(spark, ["a"]), 0)
    for _ in range(2):
        index.add(keys(spark, ["b", "c"]), 1)
        assert held(index, ["a", "b", "c"], 1) == {("a", 0)}
    assert held(index, ["a", "b", "c"], 2) == {("a", 0), ("b", 1), ("c", 1)}


def test_a_run_without_its_catalog_row_does_not_count(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path), IndexShape(fanout=2))
    index.add(keys(spark, ["a"]), 0)
    index.add(keys(spark, ["b"]), 1)
    with monkeypatch.context() as patch:
        patch.setattr("fieldpulse.streaming.runs.Runs.commit", lambda *_, **__: (_ for _ in ()).throw(OSError("dies here")))
        with pytest.raises(OSError):
            index.merge(2)
    assert held(index, ["a", "b"]) == {("a", 0), ("b", 1)}
    index.merge(2)
    assert [run.level for run in index.runs.live()] == [1]
    index.merge(3)
    assert len(list((tmp_path / "runs").iterdir())) == 1
    assert held(index, ["a", "b"]) == {("a", 0), ("b", 1)}


def test_a_store_without_an_index_is_indexed_as_one_run(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path))
    index.build(keys(spark, ["a", "b"]).withColumn("batch_id", F.when(F.col("idempotency_key") == "a", -1).otherwise(4).cast("long")))
    index.add(keys(spark, ["c"]), 5)
    assert held(index, ["a", "b", "c"], 6) == {("a", -1), ("b", 4), ("c", 5)}


def test_new_keys_read_filters_only(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path))
    index.add(keys(spark, [f"k{i}" for i in range(1500)]), 0)
    assert index.key_files(keys(spark, [f"new{i}" for i in range(20)])) == []
    assert len(index.key_files(keys(spark, ["k7", "new1"]))) == 1


def bytes_read(index, names):
    """Bytes of the filters and key files that a look-up opens, and the files."""
    opened = []
    read = type(index.runs).read

    def noted(self, schema, paths):
        frame = read(self, schema, paths)
        opened.extend(frame.inputFiles())
        return frame
    type(index.runs).read = noted
    try:
        index.seen(keys(index.spark, names)).collect()
    finally:
        type(index.runs).read = read
    sizes = {name: Path(name.removeprefix("file://")).stat().st_size for name in opened}
    return sum(sizes.values()), sizes


def test_cost_of_a_look_up_does_not_grow_with_the_store(spark, tmp_path):
    """Ten times the keys, the same batch: about the same files, though there are ten times as many."""
    cost = {}
    for size in (3_000, 30_000):
        index = KeyIndex(spark, str(tmp_path / str(size)), IndexShape(slot_keys=512, bucket_slots=1))
        index.add(spark.range(size).select(F.concat(F.lit("key-"), "id").alias("idempotency_key"), F.lit(DAY).alias("event_date")), 0)
        cost[size], files = bytes_read(index, ["key-17", "new-1", "new-2"])
        assert 2 <= len(files) <= 6
        assert sum("part=keys" in name for name in files) <= 2
        assert held(index, ["key-17", "new-1", "new-2"]) == {("key-17", 0)}
    assert cost[30_000] < 1.5 * cost[3_000]


def test_only_the_asked_folders_are_in_the_plan(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), IndexShape(slot_keys=64, bucket_slots=1))
    index.add(keys(spark, [f"k{i}" for i in range(1000)]), 0)
    found = index.seen(keys(spark, ["k3"]))
    assert len({name.rsplit("/", 1)[0] for name in found.inputFiles() if "part=keys" in name}) == 1
    assert len(list((tmp_path / "runs" / "run=l0-0-0" / "part=keys").glob("bucket=*"))) == 16


def test_first_of_new_keys(deliveries, spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path))
    index.add(keys(spark, ["a"]), 0)
    rows = deliveries(("a", "00:10", "00:13", 1.0), ("b", "00:10", "00:15", 2.0), ("b", "00:10", "00:14", 3.0))
    assert [row.value for row in dedup_against_index(rows, index).collect()] == [3.0]
