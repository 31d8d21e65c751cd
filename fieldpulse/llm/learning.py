"""Labels, bounded samples and hashed folds for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import LONG_ROW, stored


def fold(doc_id: Column, folds: int) -> Column:
    """CRC32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, purpose: str) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled documents of the usable folds, chosen by hash.

    Null labels and ids are left out; an id labelled twice takes its larger label. The number is bounded in
    expectation, so the list of ids is small enough to be broadcast at any size of the corpus.
    """
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label")))
    total = clean.count()
    chosen = clean.where(chance(F.col("doc_id"), "labels") < min(1.0, most / max(1, total)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), purpose, most * LONG_ROW)


def chance(doc_id: Column, salt: str) -> Column:
    """A number in [0, 1) from the id."""
    return (F.xxhash64(doc_id, F.lit(salt)).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
