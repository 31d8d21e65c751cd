"""Exact nearest neighbours by a block matrix join: int8 product tiles with error bounds, then float recomputation.

Vectors are scaled to int8 and packed into blocks. Every query block meets every candidate block in one tile, whose
integer products come from one matrix product. With x = x' + dx for the rounded vector x', the product q.c lies
within |q| |dc| + |dq| |c'| of q'.c', so a candidate whose upper bound is below the k-th largest lower bound of its tile cannot be among
the k nearest. The surviving pairs are recomputed in double precision, a heap per query keeps the k best of a
tile, and the heaps of all tiles are merged by rank, each task passing on its k best only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.tables import ship, stored, whole_groups


@dataclass(frozen=True)
class Tiles:
    """Rows of a block of queries and of candidates, and the number of neighbours."""
    queries: int = 2048
    candidates: int = 8192
    k: int = 20


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: an id and a vector without null or non-finite components that is not zero."""
    part = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return part.where("vec_id is not null and embedding is not null").where(finite & F.exists("embedding", lambda x: x != 0))


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (in a float type in which their products are exact), scales and norms of the rounding errors."""
    scale = np.maximum(np.abs(vectors).max(axis=1) / 127, np.finfo(np.float64).tiny)
    values = np.rint(vectors / scale[:, None])
    error = np.linalg.norm(vectors - values * scale[:, None], axis=1)
    return values.astype(np.float32 if vectors.shape[1] * 127 ** 2 <= 1 << 24 else np.float64), scale, error


def _dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row products in double precision, summed from the first component to the last."""
    total = np.zeros(len(left))
    for component in range(left.shape[1]):
        total += left[:, component] * right[:, component]
    return total


class _Heaps:
    """The k best (score, smaller id first) candidates of each query of a block."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap = self.heaps[query]
        for entry in zip(scores.tolist(), (-ids).tolist()):
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def _tile(queries: np.ndarray, q_ids: np.ndarray, candidates: np.ndarray, c_ids: np.ndarray, heaps: _Heaps) -> None:
    k = heaps.k
    q_int, q_scale, q_error = _quantised(queries)
    c_int, c_scale, c_error = _quantised(candidates)
    q_norm, c_near = np.linalg.norm(queries, axis=1), np.linalg.norm(c_int, axis=1) * c_scale
    step = max(1, (1 << 21) // max(1, len(c_ids)))
    for first in range(0, len(q_ids), step):
        part = slice(first, first + step)
        near = (q_int[part] @ c_int.T).astype(np.float64) * q_scale[part, None] * c_scale[None, :]
        # One part in 10^9 more for the rounding of the double arithmetic itself.
        bound = (q_norm[part, None] * c_error[None, :] + q_error[part, None] * c_near[None, :]) * (1 + 1e-9) + 1e-9 * q_norm[part, None] * (c_near + c_error)[None, :]
        own = q_ids[part, None] == c_ids[None, :]
        low = np.where(own, -np.inf, near - bound)
        floor = np.full(len(low), -np.inf)
        if len(c_ids) > k:
            floor = np.partition(low, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
        query, other = np.nonzero((near + bound >= floor[:, None]) & ~own)
        scores = _dot(queries[first + query], candidates[other])
        cuts = np.searchsorted(query, np.arange(len(floor) + 1))
        for row in range(len(floor)):
            heaps.add(first + row, scores[cuts[row]:cuts[row + 1]], c_ids[other[cuts[row]:cuts[row + 1]]])


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query: Column, tiles: Tiles = Tiles()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by inner product of each row of ``vectors(vec_id, embedding)`` that
    satisfies ``is_query``, nearest first, ties to the smaller vec_id; all candidates if there are fewer.

    Rows with a null, empty or zero vector, with a null or non-finite component, or without vec_id take no part. A vector
    meets those of its own length only. Rows that repeat a vec_id count each. Of candidates with the same vector only the k + 1
    smallest ids, and k rows of each, can be among the k nearest, so no more of them are compared. Other columns are not used.
    """
    ship(vectors.sparkSession)
    rows = stored(usable(vectors).withColumn("dims", F.size("embedding")), "vectors")
    # Ids are ranked, not rows: a query leaves out all rows of its own id, and k others must stay.
    copy = F.row_number().over(Window.partitionBy("embedding", "vec_id").orderBy("dims"))
    place = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    candidates = rows.withColumn("_copy", copy).where(F.col("_copy") <= tiles.k)
    candidates = candidates.withColumn("_place", place).where(F.col("_place") <= tiles.k + 1).drop("_copy", "_place")
    queries = rows.where(is_query)
    n_queries, n_candidates = queries.count(), rows.count()
    q_blocks, c_blocks = -(-n_queries // tiles.queries) or 1, -(-n_candidates // tiles.candidates) or 1
    q_side = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")).withColumn(
        "c_block", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))).select(
        F.xxhash64("dims", "block", "c_block").alias("tile"), F.lit(True).alias("query"), "vec_id", "embedding")
    c_side = candidates.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(c_blocks)).cast("int")).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).select(
        F.xxhash64("dims", "q_block", "block").alias("tile"), F.lit(False).alias("query"), "vec_id", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile"):
            tile, query, ids = (table.column(name).to_numpy() for name in ("tile", "query", "vec_id"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]])
            for first_row, last_row in zip(cuts, cuts[1:]):
                asked = query[first_row:last_row]
                if asked.all() or not asked.any():
                    continue
                matrix = _matrix(table.column("embedding").slice(first_row, last_row - first_row))
                held = ids[first_row:last_row]
                heaps = _Heaps(held[asked], tiles.k)
                _tile(matrix[asked], held[asked], matrix[~asked], held[~asked], heaps)
                best = [sorted(heap, reverse=True) for heap in heaps.heaps]
                yield pa.record_batch([pa.array(np.repeat(heaps.ids, [len(b) for b in best])), pa.array([-i for b in best for _, i in b], pa.int64()),
                                       pa.array([s for b in best for s, _ in b], pa.float64())], ["query_id", "vec_id", "score"])
    found = (q_side.unionByName(c_side).repartition("tile").sortWithinPartitions("tile")
             .mapInArrow(run, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= tiles.k).select("query_id", "rank", "vec_id", "score")
