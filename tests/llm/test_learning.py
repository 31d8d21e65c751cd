"""Samples of labels."""

from pyspark.sql import functions as F

from fieldpulse.llm.learning import label_sample


def test_label_sample_is_written_by_its_rows(docs, spark):
    table = docs(*[(i, f"text {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sample = label_sample(table, labels, "quality", F.lit(True), 100, "sample")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert len(sample.inputFiles()) == 1
    assert {(row.doc_id, row.text, row.label) for row in sample.collect()} == {(i, f"text {i}", i % 2) for i in range(40)}
