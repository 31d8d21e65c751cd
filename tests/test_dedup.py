import random

from telemetry_rows import at
from pyspark.sql import functions as F

from fieldpulse.operators import dedup, outcome
from fieldpulse.operators.skew import HotGroups


def rows_of(frame, *names):
    return sorted(tuple(row[name] for name in names) for row in frame.collect())


def test_first_delivery_wins_whole(deliveries):
    frame = deliveries(("a", "00:10", "00:12", 7.0), ("a", "00:10", "00:11", 1.0, "d2"),
                       ("b", "00:10", "00:11", 2.0), ("b", "00:10", "00:11", 3.0))
    # Equal arrival times go by delivery number; the key is global, so the device does not matter.
    assert rows_of(dedup.dedup_first_wins(frame), "idempotency_key", "value", "device_id") == [
        ("a", 1.0, "d2"), ("b", 2.0, "d1")]


def test_null_fields_of_the_first_delivery_are_kept(deliveries):
    frame = deliveries(("a", None, "00:11", None), ("a", "00:10", "00:12", 2.0))
    assert rows_of(dedup.dedup_first_wins(frame), "idempotency_key", "value", "recorded_at") == [
        ("a", None, None)]


def test_mark_first_against_brute_force(deliveries):
    rng = random.Random(3)
    frame = deliveries(*[(f"k{rng.randrange(8) if rng.random() < .6 else 0}", "00:10",
                          f"00:{rng.randrange(10, 50)}", float(i % 3)) for i in range(300)])
    marked = dedup.mark_first(frame, eligible=F.col("value") > 0).collect()
    assert len(marked) == 300
    best = {}
    for row in marked:
        if row["value"] > 0:
            order = (row["ingested_at"], row["delivery_seq"])
            best[row["idempotency_key"]] = min(best.get(row["idempotency_key"], order), order)
    for row in marked:
        first = best.get(row["idempotency_key"]) == (row["ingested_at"], row["delivery_seq"])
        assert row["is_first"] == (first and row["value"] > 0)


def test_copies_of_a_hot_key_spread_over_the_join(deliveries, capsys):
    frame = deliveries(("a", "00:10", "00:12", 7.0), ("a", "00:10", "00:13", 1.0))
    dedup.mark_first(frame.hint("merge")).explain()
    plan = capsys.readouterr().out
    joined = plan[plan.index("SortMergeJoin"):].splitlines()[0]
    assert "delivery_seq" in joined and "idempotency_key" in joined


def test_against_store(deliveries):
    stored = deliveries(("a", "00:10", "00:11", 1.0), ("z", "00:10", "00:11", 1.0))
    batch = deliveries(("a", "00:10", "00:20", 5.0), ("b", "00:10", "00:21", 6.0),
                       ("b", "00:10", "00:22", 7.0))
    for limit in (1, 1_000):
        assert rows_of(dedup.seen_keys(batch, stored, max_broadcast=limit), "idempotency_key") == [("a",)]
    assert rows_of(dedup.dedup_against_store(batch, stored), "idempotency_key", "value") == [("b", 6.0)]


def test_duplicates_answer_with_the_stored_row(deliveries):
    frame = deliveries(("a", "00:10", "00:11", 1.0), ("a", "00:10", "00:20", 5.0, "d2"),
                       ("b", "00:10", "00:11", 1.0))
    for hot in (HotGroups(), HotGroups(min_rows=1)):
        answers = dedup.resolve_duplicates(frame, dedup.dedup_first_wins(frame), hot=hot)
        assert rows_of(answers, "idempotency_key", "delivery_seq", "stored_device_id", "stored_value") == [
            ("a", 1, "d1", 1.0)]
    assert dedup.duplicate_count(frame).first()[0] == 1
    assert dedup.duplicate_count(frame.where("false")).first()[0] == 0


def test_the_content_key_lets_copies_through(deliveries):
    """Why the client supplies the key: a defaulted time differs between copies."""
    frame = deliveries(("a", None, "00:11", 1.0), ("a", None, "00:20", 1.0)).withColumn(
        "recorded_at", F.coalesce("recorded_at", "ingested_at"))
    assert frame.dropDuplicates(["device_id", "metric_type", "recorded_at"]).count() == 2
    kept = dedup.dedup_first_wins(frame).collect()
    assert [row["recorded_at"] for row in kept] == [at("00:11")]


def test_cached_labels_have_tasks_by_their_rows(spark, deliveries, devices):
    """AQE leaves a cached plan's partitions alone, and each shuffle that starts from them costs a file per task and partition."""
    rows = spark.range(20_000).crossJoin(deliveries(("a", "00:10", "00:20", 1.0)).withColumn("decode_error", F.lit(False)))
    rows = rows.withColumn("idempotency_key", F.concat("idempotency_key", (F.col("id") % 15_000).cast("string"))).withColumn("delivery_seq", F.col("id")).drop("id")
    checked = outcome.check_deliveries(rows, devices("d1"), message=False).persist()
    labelled = outcome.label_outcomes(checked, hot=HotGroups()).persist()
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert {row.outcome: row["count"] for row in labelled.groupBy("outcome").count().collect()} == {"ACCEPTED": 15_000, "DUPLICATE": 5_000}
        assert labelled.rdd.getNumPartitions() <= 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
        labelled.unpersist()
        checked.unpersist()
