"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred vectors X (one per distinct vector) stay in blocks on the executors. A step multiplies X by a direction, which gives the next left vector u,
and the transpose of X by u, which gives the next direction v; both products are taken in one scan, block by block, and their sums are one short row per
task. u has an entry per vector and is never stored: every u is X times a short coefficient vector p, and with the products kept, the
inner products of a new u with all earlier ones follow from those, so it is orthogonalised by its coefficients. v is orthogonalised against all
earlier ones as it is. There is no state on the executors to lose. The products leave a small bidiagonal matrix whose
singular value decomposition gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import ship, stored

MOST_LONG = (1 << 63) - 1
FEW_FILES = 64  # from so few tasks the driver takes the partial sums itself, which saves a shuffle per step


@dataclass(frozen=True)
class Bidiagonal:
    """``components`` wanted; a component is final when its residual is at most ``tolerance`` times the largest singular value. Singular values
    below ``rank`` times the largest count as zero."""
    components: int = 4
    tolerance: float = 1e-14
    rank: float = 1e-10
    block_bytes: int = 8 << 20
    seed: int = 12


@dataclass(frozen=True)
class Components:
    """What whitening needs: n fitted vectors, their sums, unit components as columns, variances and their trace."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([total / self.n for total in self.sums])


def integer_vectors(vectors: DataFrame, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The ``keep`` columns as ``_row`` and x, the floor of 256 times each entry; rows whose vector is null or holds a null or
    non-finite entry are left out. Entries beyond the range of a long take its bounds."""
    part = vectors.select(F.struct(*keep).alias("_row"), F.col("embedding").cast("array<double>").alias("e")).where("e is not null")
    part = part.where(F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return part.select("_row", F.transform("e", lambda c: F.floor(c * 256).cast("long")).alias("x"))


def _packed(rows: DataFrame, dims: int, shape: Bidiagonal) -> DataFrame:
    """Each distinct x once, as blocks of integers of the fewest bytes that hold them."""
    most = max(1, shape.block_bytes // (8 * dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts: list[np.ndarray]) -> pa.RecordBatch:
            matrix = np.concatenate(parts)
            kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= matrix.min() and matrix.max() <= np.iinfo(t).max)
            return pa.record_batch([pa.array([kind]), pa.array([matrix.astype(kind).tobytes()], pa.binary())], ["kind", "matrix"])
        held: list[np.ndarray] = []
        for batch in batches:
            matrix = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for begin in range(0, len(matrix), most):
                held.append(matrix[begin:begin + most])
                if sum(map(len, held)) >= most:
                    yield block(held)
                    held = []
        if sum(map(len, held)):
            yield block(held)
    # Dealt by the vectors' bytes, so that small tables make one block.
    distinct = rows.select("x").distinct()
    tasks = -(-rows.count() * 8 * dims // shape.block_bytes)
    return (distinct.coalesce(1) if tasks <= 1 else distinct).mapInArrow(run, "kind string, matrix binary")


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, matrix in zip(batch.column("kind"), batch.column("matrix")):
            yield np.frombuffer(matrix.as_buffer(), kind.as_py()).reshape(-1, dims)


def _summed(blocks: DataFrame, dims: int, mean: np.ndarray, width: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``work`` of each centred block, added up; a task sends ``width`` numbers, and the driver gets as many, from few tasks once for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for matrix in _matrices(batches, dims):
            total += work(matrix - mean)
        yield pa.record_batch([pa.array(np.arange(width), pa.int32()), pa.array(total)], ["place", "value"])
    parts = blocks.mapInArrow(run, "place int, value double")
    if len(blocks.inputFiles()) > FEW_FILES:
        parts = parts.groupBy("place").agg(F.sum("value").alias("value"))
    rows = parts.toArrow()
    return np.bincount(rows.column("place").to_numpy(), rows.column("value").to_numpy(), width)


def _totals(blocks: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """Number of vectors, sums per dimension and sum of all squares, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, squares = 0, [0] * dims, 0
        for matrix in _matrices(batches, dims):
            # Python integers take over where 64 bits could overflow.
            top = max(abs(int(matrix.min())), abs(int(matrix.max())))
            wide = matrix.astype(np.int64 if top ** 2 * matrix.size < 1 << 62 else object)
            count += len(matrix)
            sums = [a + int(b) for a, b in zip(sums, wide.sum(axis=0))]
            squares += int((wide * wide).sum())
        yield pa.record_batch([pa.array(range(dims + 2), pa.int32()), pa.array([str(v) for v in (*sums, count, squares)])], ["place", "value"])
    parts = blocks.mapInArrow(run, "place int, value string").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {row.place: int(row.value) for row in parts.collect()}
    return found[dims], [found[i] for i in range(dims)], found[dims + 1]


def _against(v: np.ndarray, held: list[np.ndarray]) -> np.ndarray:
    """v made orthogonal to all held unit vectors, twice for the rounding of the first time."""
    if held:
        basis = np.stack(held, axis=1)
        for _ in range(2):
            v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], dims: int, away: list[np.ndarray], wanted: int, draw: np.random.Generator,
                  shape: Bidiagonal) -> tuple[np.ndarray, np.ndarray, bool]:
    """Singular values (falling) and right vectors of X on the complement of ``away``, and whether the steps ended in an invariant space.

    ``product`` gives the transpose of X times X times a vector. Stops when the ``wanted`` largest are final. The matrix is alpha on the diagonal and
    beta above it.
    """
    v = _against(draw.normal(size=dims), away)
    vs, ps, backs, alphas, betas = [v / np.linalg.norm(v)], [], [], [], []
    beta, scale = 0.0, 0.0
    while True:
        # u = X q, less its parts along earlier u; all are known by their coefficients p and by their products with the transpose.
        q = vs[-1] - beta * ps[-1] if ps else vs[-1]
        back = product(q)
        along = np.array([held @ q for held in backs])
        alpha = float(np.sqrt(max(0.0, q @ back - along @ along)))
        scale = max(scale, alpha, beta)
        ended = alpha <= shape.rank * scale or scale == 0.0
        if not ended:
            p = (q - sum(c * held for c, held in zip(along, ps))) / alpha
            back = (back - sum(c * held for c, held in zip(along, backs))) / alpha
            length = float(np.sqrt(p @ back))  # 1 but for rounding
            ps.append(p / length)
            backs.append(back / length)
            alphas.append(alpha * length)
            w = _against(backs[-1] - alphas[-1] * vs[-1], [*away, *vs])
            beta = float(np.linalg.norm(w))
            scale = max(scale, beta)
            ended = beta <= 1e-15 * scale or len(vs) + len(away) == dims
        if not ps:
            return np.zeros(1), np.stack(vs, axis=1), True
        matrix = np.zeros((len(ps), len(vs)))
        np.fill_diagonal(matrix, alphas)
        np.fill_diagonal(matrix[:, 1:], betas)
        left, values, right = np.linalg.svd(matrix)
        values = np.append(values, np.zeros(len(vs) - len(values)))
        if ended:
            return values, np.stack(vs, axis=1) @ right.T, True
        # Past half of the dimensions it is cheaper to go to the end than to look at the complement afterwards.
        early = 2 * len(vs) <= dims - len(away)
        if early and len(values) >= wanted and (beta * np.abs(left[-1, :wanted]) <= shape.tolerance * values[0]).all():
            return values[:wanted], np.stack(vs, axis=1) @ right.T[:, :wanted], False
        betas.append(beta)
        vs.append(w / beta)


def fit(blocks: DataFrame, dims: int, shape: Bidiagonal = Bidiagonal()) -> Components:
    """Components of the distinct vectors in ``blocks``, at most ``shape.components``, those without variance left out."""
    n, sums, squares = _totals(blocks, dims)
    trace = (n * squares - sum(total * total for total in sums)) / n ** 2
    mean = np.array([total / n for total in sums])
    values, vectors = np.zeros(0), np.zeros((dims, 0))
    if trace > 0:
        values, vectors = largest(lambda q: _summed(blocks, dims, mean, dims, lambda x: x.T @ (x @ q)), dims, shape)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]) if len(values) else np.ones(0)
    return Components(n, sums, vectors * signs, values ** 2 / n, trace)


def largest(product: Callable[[np.ndarray], np.ndarray], dims: int, shape: Bidiagonal) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values and their right vectors.

    One run finds each of several equal values once only, so further runs look at what is orthogonal to all found, until the largest value there
    does not exceed those wanted or nothing is left.
    """
    values, vectors, draw = np.zeros(0), np.zeros((dims, 0)), np.random.default_rng(shape.seed)
    while vectors.shape[1] < dims:
        first = not len(values)
        found, right, _ = bidiagonalise(product, dims, list(vectors.T), shape.components if first else 1, draw, shape)
        least = np.sort(values)[::-1][shape.components - 1] if len(values) >= shape.components else 0.0
        values, vectors = np.append(values, found), np.concatenate([vectors, right], axis=1)
        if not first and found[0] <= max(least, shape.rank * values.max()):
            break
    order = np.argsort(-values, kind="stable")[:shape.components]
    order = [i for i in order if values[i] > shape.rank * values.max()]
    return values[order], vectors[:, order]


def _identity_error(blocks: DataFrame, dims: int, fitted: Components) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    size = len(fitted.variances)
    to_unit = fitted.vectors / np.sqrt(fitted.variances)

    def work(x: np.ndarray) -> np.ndarray:
        made = x @ to_unit
        return np.append((made.T @ made).ravel(), made.sum(axis=0))
    total = _summed(blocks, dims, fitted.mean, size * (size + 1), work) / fitted.n
    return float(np.abs(total[:size * size].reshape(size, size) - np.outer(total[size * size:], total[size * size:]) - np.eye(size)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S) ** 2 per row, exact; null where a long can't hold it."""
    if not len(x):
        return []
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if top ** 2 * len(sums) <= MOST_LONG:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(value) if value <= MOST_LONG else None for value in exact]


def whiten(vectors: DataFrame, shape: Bidiagonal = Bidiagonal(), keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The ``keep`` columns of every row of ``vectors(embedding)`` with a finite vector, once per component: component (from 1), n, deviation,
    whitened, explained, identity_error.

    Each distinct integer vector is fitted once, however many rows hold it, and rows that repeat all get their result. Vectors of different lengths
    are fitted apart, one length after the other; an empty vector has no component and so no row. Components without variance give no rows:
    a single distinct vector, or an empty table, gives none. Equal variances leave the choice of components within their space open; all
    rows use the same. Other columns are not used.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(integer_vectors(vectors, keep), "integer-vectors")
    kind = rows.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = spark.createDataFrame([], schema)
    lengths = [row.dims for row in rows.groupBy(F.size("x").alias("dims")).count().orderBy("dims").collect() if row.dims > 0]
    for dims in lengths:
        own = rows.where(F.size("x") == dims)
        blocks = stored(_packed(own, dims, shape), "vector-blocks")
        fitted = fit(blocks, dims, shape)
        if len(fitted.variances):
            out = out.unionByName(_whitened(own, dims, fitted, _identity_error(blocks, dims, fitted), schema))
    return out.select("_row.*", "component", "n", "deviation", "whitened", "explained", "identity_error")


def _whitened(rows: DataFrame, dims: int, fitted: Components, error: float, schema: str) -> DataFrame:
    to_unit, mean = fitted.vectors / np.sqrt(fitted.variances), fitted.mean
    explained = fitted.variances / fitted.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(explained)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            n = len(x)
            each = np.repeat(np.arange(n), size)
            yield pa.record_batch([
                batch.column("_row").take(pa.array(each)), pa.array(np.tile(np.arange(1, size + 1), n), pa.int32()),
                pa.array(np.full(n * size, fitted.n)), pa.array(deviations(x, fitted.n, fitted.sums), pa.int64()).take(pa.array(each)),
                pa.array(((x - mean) @ to_unit).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * size, error))],
                ["_row", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)
