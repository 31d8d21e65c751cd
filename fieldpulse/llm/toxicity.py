"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed words and word beginnings. The machine gives every term a weight and a short vector; the
score is the sum of the weights plus the product of the vectors of every pair of terms, so it can learn that an insult together with
another term means more than either alone. Terms are picked by the chi-square of their counts in labelled documents.

The fit uses a bounded sample of labelled documents (``Machine.most_labels``); scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.learning import label_sample
from fieldpulse.llm.tables import ship
from fieldpulse.llm.words import Slice, slices, words


@dataclass(frozen=True)
class Machine:
    """Size of the hash space (bits), terms kept, length of their vectors, and how it is fitted."""
    bits: int = 20
    terms: int = 1024
    factors: int = 6
    prefixes: tuple[int, ...] = (4, 5, 6)
    most_labels: int = 12_000
    epochs: int = 25
    rate: float = 0.02
    decay: float = 1e-4


@dataclass
class Fitted:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _terms(part: Slice, machine: Machine) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the distinct terms of a slice's documents."""
    found = words(part, prefixes=machine.prefixes)
    doc, hashed = [found.doc], [found.hash]
    for head in found.prefix.values():
        doc.append(found.doc[head != 0])
        hashed.append(head[head != 0])
    bucket = (np.concatenate(hashed) >> np.uint64(64 - machine.bits)).astype(np.int64)
    pairs = np.unique((np.concatenate(doc).astype(np.int64) << machine.bits) | bucket)
    return pairs >> machine.bits, pairs & ((1 << machine.bits) - 1)


def _counts(sample: DataFrame, machine: Machine) -> DataFrame:
    """(bucket, positive, negative): documents of the sample with the term, summed per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << machine.bits), np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for part in slices(batch.column("text")):
                doc, bucket = _terms(part, machine)
                toxic = label[part.first + doc] == 1
                total[1] += np.bincount(bucket[toxic], minlength=1 << machine.bits)
                total[0] += np.bincount(bucket[~toxic], minlength=1 << machine.bits)
        seen = np.flatnonzero(total.sum(axis=0))
        yield pa.record_batch([pa.array(seen), pa.array(total[1, seen]), pa.array(total[0, seen])], ["bucket", "positive", "negative"])
    counted = sample.mapInArrow(run, "bucket long, positive long, negative long")
    return counted.groupBy("bucket").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", machine: Machine = Machine()) -> Fitted:
    """Fits the machine on labels (1: toxic) of rows where ``usable`` holds. Without labels of both kinds, the machine is constant."""
    ship(docs.sparkSession)
    sample = label_sample(docs, labels, label, usable, machine.most_labels, "toxicity")
    toxic, total = (int(x or 0) for x in sample.agg(F.sum("label"), F.count(F.lit(1))).first())
    prior = np.log((toxic + 0.5) / (total - toxic + 0.5))
    if not 0 < toxic < total:
        return Fitted(np.zeros(0, np.int64), float(prior), np.zeros(0, np.float32), np.zeros((0, machine.factors), np.float32))
    p, n = F.col("positive").cast("double"), F.col("negative").cast("double")
    seen = p + n
    chi = (p * (total - toxic) - n * toxic) ** 2 / (seen * (total - seen + 0.5))
    top = _counts(sample, machine).where("positive + negative >= 3").orderBy(chi.desc(), "bucket").limit(machine.terms)
    terms = np.sort(np.array([row.bucket for row in top.select("bucket").collect()], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                doc, term = _known(part, terms, machine)
                cuts = np.searchsorted(doc, np.arange(part.n_docs + 1))
                yield pa.record_batch([batch.column("doc_id").slice(part.first, part.n_docs), batch.column("label").slice(part.first, part.n_docs),
                                       pa.array([term[a:b].astype(np.int16).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                                      ["doc_id", "label", "terms"])
    rows = sorted(sample.mapInArrow(run, "doc_id long, label int, terms binary").collect(), key=lambda row: row.doc_id)
    design = np.zeros((len(rows), len(terms)), np.float32)
    for number, row in enumerate(rows):
        design[number, np.frombuffer(row.terms, np.int16)] = 1
    return _descend(design, np.array([row.label for row in rows], np.float32), terms, prior, machine)


def _known(part: Slice, terms: np.ndarray, machine: Machine) -> tuple[np.ndarray, np.ndarray]:
    """(document, number of the term) of the terms that the machine keeps."""
    doc, bucket = _terms(part, machine)
    at = np.minimum(np.searchsorted(terms, bucket), max(0, len(terms) - 1))
    held = terms[at] == bucket if len(terms) else np.zeros(len(bucket), bool)
    return doc[held], at[held]


def _descend(design: np.ndarray, label: np.ndarray, terms: np.ndarray, prior: float, machine: Machine) -> Fitted:
    """Logistic loss by Adam on small batches."""
    draw = np.random.default_rng(7)
    size = len(terms)
    state = [np.array([prior], np.float32), np.zeros(size, np.float32), draw.normal(0, 0.02, (size, machine.factors)).astype(np.float32)]
    first, second, step = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state], 0
    for _ in range(machine.epochs):
        order = draw.permutation(len(label))
        for begin in range(0, len(order), 256):
            rows = order[begin:begin + 256]
            x, (bias, weights, factors) = design[rows], state
            sums = x @ factors
            margin = bias + x @ weights + 0.5 * (sums ** 2 - x @ factors ** 2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[rows]) / len(rows)
            slope = [error.sum(keepdims=True), x.T @ error + machine.decay * weights,
                     x.T @ (error[:, None] * sums) - (x.T @ error)[:, None] * factors + machine.decay * factors]
            step += 1
            for index, value in enumerate(slope):
                first[index] = 0.9 * first[index] + 0.1 * value
                second[index] = 0.999 * second[index] + 0.001 * value ** 2
                state[index] = (state[index] - machine.rate * (first[index] / (1 - 0.9 ** step))
                                / (np.sqrt(second[index] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Fitted(terms, float(state[0][0]), state[1], state[2])


def margins(part: Slice, fitted: Fitted, machine: Machine) -> np.ndarray:
    doc, term = _known(part, fitted.terms, machine)
    total = fitted.bias + np.bincount(doc, fitted.weights[term], part.n_docs)
    for factor in fitted.factors.T.astype(np.float64):
        held = factor[term]
        total += 0.5 * (np.bincount(doc, held, part.n_docs) ** 2 - np.bincount(doc, held ** 2, part.n_docs))
    return total


def score(docs: DataFrame, fitted: Fitted, machine: Machine = Machine()) -> DataFrame:
    """(doc_id, score) of every row of ``docs(doc_id, text)``, score in [0, 1].

    The machine reads nothing but the text; a null or empty text, or one without known terms, gets the base rate. Repeated rows stay. Other
    columns are not used.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                total = np.clip(margins(part, known.value, machine), -30, 30)
                yield pa.record_batch([batch.column("doc_id").slice(part.first, part.n_docs), pa.array(1 / (1 + np.exp(-total)))], ["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
