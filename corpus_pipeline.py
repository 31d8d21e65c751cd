"""From raw documents to a training mix: quality, line dedup, near copies, decontamination, mixing.

Every stage takes all rows that the stage before it kept and returns them with the columns of ``documents``; the last returns the
mix. Between stages the rows are written as Parquet and read again; what a stage wrote on its way, and the rows before it, are then deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.functions.files import delete_folder
from fieldpulse.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from fieldpulse.llm.learning import fold
from fieldpulse.llm.tables import given, passing
from fieldpulse.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    fitted = quality.fit(docs, given(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    return quality.good_documents(docs, fitted)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share, n_chars set anew; what is left empty by that goes."""
    index = line_dedup.LineIndex(spark).insert(docs)
    cut = line_dedup.without_common_lines(docs, index)
    changed = F.col("n_dropped") > 0
    rows = cut.where(~changed | (F.col("kept") != "")).withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
    return rows.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark."""
    return decontaminate.without_passages(docs, given(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each."""
    mixed = mixing.mix(docs)
    return mixed.where("copies > 0").select(
        "doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_common_lines),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("mixing sources", mix_sources),
]

# The classifier's decisions cannot be stated in SQL; tests/llm/test_plain.py holds all stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = given(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        with passing(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
