"""Text quality by positive-unlabelled learning.

Trusted positives are labelled good documents, the unlabelled set is web text of any kind; negative labels are not used. A first
classifier separates the two sets; the share of good documents in the unlabelled set, the class prior, is the smallest ratio of
unlabelled to positive documents above a score, with an allowance for sampling error. The final classifier minimises the non-negative
unbiased risk: prior * positives as good, plus the larger of zero and (unlabelled as bad - prior * positives as bad).

Both are linear in intervals of style measures (repetition, capitals, marks, length, ...), which need no language. They are
fitted on bounded samples (``Learner.most``); scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.learning import chance, label_sample
from fieldpulse.llm.tables import ship, stored
from fieldpulse.llm.words import TOKEN, Slice, slices, words

MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in "#$%&*|<>{}[]=~^_\\/@+"]] = True
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".,;:!?"]] = True
MEASURES = ("length", "distinct", "adjacent", "pairs", "capitals", "marks", "stops", "digits", "token_bytes", "lines", "marked_tokens", "bangs")


@dataclass(frozen=True)
class Learner:
    """Documents per sample, intervals per measure, steps, step size, and decay of the weights."""
    most: int = 10_000
    intervals: int = 24
    steps: int = 600
    rate: float = 0.05
    decay: float = 1e-3


@dataclass
class Fitted:
    edges: np.ndarray
    weights: np.ndarray
    prior: float


def measures(part: Slice) -> np.ndarray:
    """Style measures of each document of a slice, a row each."""
    n, data = part.n_docs, part.data
    found = words(part, TOKEN)
    sizes = np.diff(part.offsets)
    owner = np.repeat(np.arange(n), sizes)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n) / np.maximum(1, sizes)

    tokens = np.bincount(found.doc, minlength=n)
    follows = found.doc[1:] == found.doc[:-1]
    again = follows & (found.hash[1:] == found.hash[:-1])
    pair = (found.hash[1:] * np.uint64(31) + found.hash[:-1])[follows]

    def distinct(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashed, doc))
        doc, hashed = doc[order], hashed[order]
        fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])]) if len(doc) else np.zeros(0, bool)
        return np.bincount(doc[fresh], minlength=n)

    marked = np.concatenate([[0], np.cumsum(MARKS[data])])
    has_mark = marked[found.end] > marked[found.start]
    capital, small = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    letters = np.bincount(owner[capital | small], minlength=n)
    some = np.maximum(1, tokens)
    return np.stack([
        np.log1p(tokens),
        # Distinct words fall with length in any text, so they are held against a power of it.
        distinct(found.doc, found.hash) / some ** 0.85,
        np.bincount(found.doc[1:][again], minlength=n) / some,
        distinct(found.doc[1:][follows], pair) / some,
        np.bincount(owner[capital], minlength=n) / np.maximum(1, letters),
        share(MARKS[data]), share(STOPS[data]), share((data >= 48) & (data <= 57)),
        np.bincount(found.doc, found.end - found.start, n) / some,
        np.bincount(owner[data == 10], minlength=n) / some,
        np.bincount(found.doc[has_mark], minlength=n) / some,
        np.bincount(owner[data == 33], minlength=n) / some,
    ], axis=1)


def _measured(docs: DataFrame) -> np.ndarray:
    """Measures of a bounded sample, in the order of doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                rows = measures(part)
                yield pa.record_batch([batch.column("doc_id").slice(part.first, part.n_docs),
                                       pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "m"])
    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, m array<double>").collect()
    return np.array([row.m for row in sorted(rows, key=lambda row: (row.doc_id, row.m))]).reshape(len(rows), len(MEASURES))


def _design(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Interval indicators of every measure and a constant."""
    columns = [np.ones((len(rows), 1), np.float32)]
    for measure, cuts in enumerate(edges):
        at = np.searchsorted(cuts, rows[:, measure], "right")
        columns.append((at[:, None] == np.arange(len(cuts) + 1)[None, :]).astype(np.float32))
    return np.concatenate(columns, axis=1)


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def _descend(good: np.ndarray, other: np.ndarray, prior: float | None, learner: Learner) -> np.ndarray:
    """Weights of good against other by the logistic loss without a prior, else by the non-negative positive-unlabelled risk.

    That risk takes the sigmoid loss: an unbounded loss would let the confident positives outweigh a small error of the prior.
    """
    weights = np.zeros(good.shape[1])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, learner.steps + 1):
        p, u = _sigmoid(good @ weights), _sigmoid(other @ weights)
        if prior is None:
            slope = (p - 1) @ good / len(good) + u @ other / len(other)
        else:
            p_slope, u_slope = (p * (1 - p)) @ good / len(good), (u * (1 - u)) @ other / len(other)
            # A negative estimate of the risk of bad documents is a sign of overfitting: step back from it.
            slope = u_slope - 2 * prior * p_slope if u.mean() >= prior * p.mean() else prior * p_slope - u_slope
        slope = slope + learner.decay * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        weights = weights - learner.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return weights


def class_prior(good: np.ndarray, other: np.ndarray, risk: float = 0.1) -> float:
    """Share of positives in the unlabelled scores ``other``: the smallest ratio of upper tails, with its sampling error."""
    cuts = np.unique(np.concatenate([good, other]))
    tail = lambda x: 1 - np.searchsorted(np.sort(x), cuts, "left") / len(x)
    margin = sum(np.sqrt(np.log(4 / risk) / (2 * len(x))) for x in (good, other))
    upper, lower = tail(other), tail(good)
    best = np.argmin(np.where(lower > 0, (upper + margin) / np.maximum(lower, 1e-9), np.inf))
    return float(np.clip(upper[best] / lower[best], 0.01, 0.99))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", learner: Learner = Learner()) -> Fitted:
    """Fits on positives (label 1) of rows where ``usable`` holds, and on unlabelled documents of ``docs`` chosen by hash.

    Without positives or documents, every document scores as good.
    """
    ship(docs.sparkSession)
    trusted = labels.where(F.col(label) == 1)
    good = _measured(label_sample(docs, trusted, label, usable, learner.most, "trusted"))
    total = docs.count()
    part = docs.where(chance(F.col("doc_id"), "web") < min(1.0, learner.most / max(1, total)))
    other = _measured(stored(part.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null"), "unlabelled"))
    if not len(good) or not len(other):
        return Fitted(np.zeros((len(MEASURES), 0)), np.array([1.0, *np.zeros(len(MEASURES))]), 1.0)
    inner = np.linspace(0, 1, learner.intervals + 1)[1:-1]
    edges = np.stack([np.quantile(other[:, m], inner) for m in range(len(MEASURES))])
    g, o = _design(good, edges), _design(other, edges)
    half = np.arange(len(g)) % 2 == 0, np.arange(len(o)) % 2 == 0
    apart = _descend(g[half[0]], o[half[1]], None, learner)
    prior = class_prior(g[~half[0]] @ apart, o[~half[1]] @ apart) if (~half[0]).any() and (~half[1]).any() else 0.5
    return Fitted(edges, _descend(g, o, prior, learner), prior)


def score(docs: DataFrame, fitted: Fitted, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The ``keep`` columns and the score (0 to 1, higher: good) of every row of ``docs``.

    The score depends on the text alone; a null text counts as empty and is scored like any other. Repeated rows stay. Other columns are
    not used.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(fitted)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    columns = [*dict.fromkeys([*keep, "text"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                value = _sigmoid(_design(measures(part), known.value.edges) @ known.value.weights)
                yield pa.record_batch([*(batch.column(c).slice(part.first, part.n_docs) for c in keep), pa.array(value)], [*keep, name])
    return docs.select(*columns).mapInArrow(run, f"{fields}, `{name}` double")


def good_documents(docs: DataFrame, fitted: Fitted, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, all columns as they were."""
    name = "_quality_score"
    return score(docs, fitted, tuple(docs.columns), name).where(F.col(name) >= threshold).select(docs.columns)
