"""Whitening against a dense eigenvalue decomposition, exact sums, and odd vectors."""

import numpy as np
import pytest

from fieldpulse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, x string, matrix string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "clash", "clash", "clash") for i, v in enumerate(vectors)], SCHEMA)


def dense(vectors):
    """Integer rows, fitted rows, mean, variances (falling) and components."""
    x = np.floor(np.array(vectors, np.float32).astype(float) * 256).astype(np.int64)
    fitted = np.unique(x, axis=0)
    values, components = np.linalg.eigh(np.cov(fitted.T.astype(float), bias=True))
    return x, fitted, values[::-1], components[:, ::-1]


def check(spark, vectors, most=4):
    good = [v for v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    ids = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x, fitted, values, components = dense(good)
    rank = min(most, int((values > 1e-9 * values[0]).sum()))
    got = whitening.whiten(frame(spark, vectors)).orderBy("vec_id", "component").collect()
    assert [(row.vec_id, row.component) for row in got] == [(i, c + 1) for i in ids for c in range(rank)]
    made = np.array([row.whitened for row in got]).reshape(len(ids), rank)
    want = (x - fitted.mean(axis=0)) @ components[:, :rank] / np.sqrt(values[:rank])
    distinct = np.all(np.diff(values[:rank + 1]) < -1e-6 * values[0]) if len(values) > rank else np.all(np.diff(values) < 0)
    if distinct:
        signs = np.sign((made * want).sum(axis=0))
        assert np.abs(made * signs - want).max() < 1e-8
    assert np.abs(np.array([row.explained for row in got[:rank]]) - values[:rank] / values.sum()).max() < 1e-10
    assert {row.n for row in got} == {len(fitted)} and max(row.identity_error for row in got) < 1e-9
    exact = [sum((len(fitted) * int(c) - int(s)) ** 2 for c, s in zip(row, fitted.sum(axis=0))) for row in x]
    assert [row.deviation for row in got[::rank]] == exact
    return got


def test_whitening_matches_dense_decomposition(spark):
    draw = np.random.default_rng(2)
    vectors = list(draw.normal(size=(300, 24)) * np.linspace(3, 0.2, 24))
    vectors += [vectors[0]] * 40 + [None, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23]
    check(spark, [v if v is None else list(v) for v in vectors])


def test_few_directions_and_equal_variances(spark):
    draw = np.random.default_rng(5)
    flat = draw.normal(size=(60, 2)) @ draw.normal(size=(2, 10))
    check(spark, [list(np.round(v)) for v in flat @ np.diag([1] * 10)])
    square = [[a if i == d else 0.0 for i in range(5)] for d in range(5) for a in (1.0, -1.0)]
    got = check(spark, square)
    assert len(got) == 40


def test_wide_range_of_variances(spark):
    draw = np.random.default_rng(6)
    check(spark, [list(v) for v in draw.normal(size=(200, 40)) * np.geomspace(1000, 0.05, 40)])


def test_no_variance_gives_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).count() == 0
    assert whitening.whiten(frame(spark, [[], None])).count() == 0


def test_lengths_are_fitted_apart(spark):
    draw = np.random.default_rng(7)
    got = whitening.whiten(frame(spark, [list(v) for v in draw.normal(size=(20, 3))] + [list(v) for v in draw.normal(size=(10, 2))])).collect()
    assert {(row.n, row.component) for row in got} == {(20, 1), (20, 2), (20, 3), (10, 1), (10, 2)}


@pytest.mark.parametrize("scale", [1, 1 << 40])
def test_deviations_are_exact(scale):
    x = np.array([[3, -5], [7, 11]], np.int64) * scale
    sums = [int(c) for c in x.sum(axis=0)]
    want = [sum((2 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 2, sums) == [value if value < 1 << 63 else None for value in want]


def test_early_stop_still_finds_repeated_values(spark):
    """Tolerance that stops before all steps: the further runs must find the second copy of the largest variance."""
    rows = []
    for d, size in enumerate([8.0, 8.0, 5.0, 4.0, 3.0] + [1.0] * 30):
        rows += [[a if i == d else 0.0 for i in range(35)] for a in (size, -size)]
    check(spark, rows)
