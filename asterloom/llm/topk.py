"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments, at several resolutions; each segment keeps its
mean and the length of its deviation from it. Two vectors are at least as far
apart as their segment means and deviations are, so their inner product is at
most the sum over segments of length * mean * mean + deviation * deviation.
Coarse bounds are tried first, finer ones on what is left, and only survivors
are compared in full. The bound never cuts a row that belongs to the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (1, 4, 16)
CHUNK = 4096  # candidate rows compared at once
MAX_QUERIES = 20_000  # of one broadcast block of queries
TILE = 512  # queries whose coarse bounds are held at once: TILE * CHUNK numbers, 16 MB
EXACT = float(1 << 53)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means (times the root of the segment's length) and deviations, side by side.

    The inner product of two such rows bounds that of the vectors.
    """
    n, dim = vectors.shape
    length = -(-dim // segments)
    padded = np.zeros((n, length * segments))
    padded[:, :dim] = vectors
    padded = padded.reshape(n, segments, length)
    mean = padded.mean(axis=2)
    deviation = np.sqrt(np.maximum((padded**2).sum(axis=2) - length * mean**2, 0))
    return np.concatenate([mean * length**0.5, deviation], axis=1)


class Queries:
    """Query vectors of one length, with the best rows found so far for each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [statistics(vectors, s) for s in SEGMENTS]
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.row = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.zeros(len(ids), np.int64)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        levels = [statistics(vectors, s) for s in SEGMENTS]
        largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * vectors.shape[1]
        whole = vectors if largest < EXACT else vectors.astype(np.int64)
        slack = 1e-9 * max(largest, 1.0)
        for q in range(len(self.ids)):
            if q % TILE == 0:
                coarse = self.levels[0][q : q + TILE] @ levels[0].T
            full = self.found[q] >= self.k
            least = float(self.score[q, -1]) - slack if full else -np.inf
            left = np.flatnonzero((coarse[q % TILE] >= least) & (ids != self.ids[q]))
            if full:
                for mine, theirs in zip(self.levels[1:], levels[1:], strict=True):
                    if not len(left):
                        break
                    left = left[theirs[left] @ mine[q] >= least]
            if len(left):
                query = self.vectors[q] if largest < EXACT else self.vectors[q].astype(np.int64)
                self._merge(q, ids[left], (whole[left] @ query).astype(np.int64))

    def _merge(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            # The k-th best of these bounds what can matter; equal scores all stay.
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        have = min(self.found[q], self.k)
        scores = np.concatenate([self.score[q, :have], scores])
        ids = np.concatenate([self.row[q, :have], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.score[q, : len(order)], self.row[q, : len(order)] = scores[order], ids[order]
        self.found[q] = len(order)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists and their components in one row."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.value_lengths()), np.asarray(lists.flatten(), np.float64)


def _groups(ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray):
    """(ids, matrix) for the vectors of each length."""
    ends = np.cumsum(lengths)
    for dim in np.unique(lengths):
        own = np.flatnonzero(lengths == dim)
        at = (ends[own] - dim)[:, None] + np.arange(dim)
        yield int(dim), ids[own], flat[at]


def _search_batches(shared, k: int):
    def run(batches):
        ids, lengths, flat = shared.value
        queries = {dim: Queries(i, v, k) for dim, i, v in _groups(ids, lengths, flat)}
        for batch in batches:
            own_ids = np.asarray(batch.column("vec_id"))
            for first in range(0, batch.num_rows, CHUNK):
                part = batch.column("vector").slice(first, CHUNK)
                for dim, i, v in _groups(own_ids[first : first + CHUNK], *_matrix(part)):
                    if dim in queries:
                        queries[dim].offer(i, v)
        for q in queries.values():
            has = np.arange(k)[None, :] < q.found[:, None]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(q.ids, q.found)), pa.array(q.row[has]), pa.array(q.score[has]),
            ], ["query_id", "vec_id", "score"])
    return run


def top_k(df: DataFrame, query_ids, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query.

    `query_ids` is a condition on the column vec_id that says which rows are
    queries; every other row is a candidate. Components become
    floor(scale * x), scores are exact integers, ties go to the smaller vec_id,
    a query with fewer candidates gets all of them.

    Rows without an id, without a vector, or with a component that is null or
    not finite take no part. Vectors are compared with those of their length
    only. Rows with the query's id are the query itself; repeated ids among the
    candidates can each appear. Empty tables and query sets give an empty
    result; other columns are ignored.

    Queries go to the tasks in blocks of about MAX_QUERIES rows, one pass over
    the candidates for each block, so the broadcast doesn't grow with the table.
    A task keeps k rows a query; what all tasks keep is ranked by a window whose
    input is cut to k rows a query in each task before the shuffle.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(scale * x).cast("double")))
    wanted = rows.filter(query_ids)
    blocks = -(-wanted.count() // MAX_QUERIES)
    schema = "query_id long, vec_id long, score long"
    found = spark.createDataFrame([], schema)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        got = wanted.filter(block == b).groupBy("vec_id").agg(F.min("vector").alias("vector")).toArrow()
        ids = got.column("vec_id").to_numpy()
        shared = spark.sparkContext.broadcast((ids, *_matrix(got.column("vector"))))
        best = rows.mapInArrow(_search_batches(shared, k), schema)
        found = found.union(best) if b else best
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
