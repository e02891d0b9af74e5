"""Exact top-k search by columnar branch and bound.

Vectors are quantised to whole numbers and kept in vertical layout: block by block, one
matrix row for each dimension. Scores grow dimension block by dimension block; after each,
what is left of a pair can add at most the product of the remaining masses (Euclidean
norms over the dimensions still to come, by Cauchy and Schwarz), and candidates whose
score plus bound can't reach the query's k-th best are compacted away before the next
dimensions are looked at. Dimensions are taken in the order of their mass, so most is
known early.

Queries go out in waves of a bounded number of rows; each wave meets every candidate in
one pass, a block of candidates at a time. A task keeps k rows for each query of a wave
and starts with the best of its first block, so memory is bounded by wave and block. The
tasks' rows are merged by two steps of ranking, first within groups of tasks.

Defined cases: vectors that are null, empty or of another length than the query, or hold
null or non-finite components take no part (a shorter vector scores only with queries of
its length). Ties go to the smaller vec_id. Rows that share a vec_id are candidates one
by one, but never of a query of the same vec_id; repeated query rows count once. Null
vec_ids take no part. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.scratch import Scratch

K = 20
SCALE = 64
WAVE = 16_384
BLOCK = 8_192
STEP = 16  # dimensions looked at before candidates are compacted
TILE = 256  # queries worked on together


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the whole numbers floor(scale * x) of each vector that takes part."""
    sound = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and rows of a batch, by length of vector."""
    ids = batch.column("vec_id").to_numpy()
    lists = batch.column("v")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield ids[rows], flat[(ends[rows] - size)[:, None] + np.arange(size)]


def _tails(matrix: np.ndarray, step: int) -> np.ndarray:
    """Norm of each row over the dimensions from each block on."""
    squares = np.add.reduceat(matrix * matrix, np.arange(0, matrix.shape[1], step), axis=1)
    return np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])


class Best:
    """The k best candidates of each query of one length, by score and smaller id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, step: int):
        mass = np.argsort(-(rows * rows).sum(0), kind="stable")
        self.ids, self.k, self.step, self.mass = ids, k, step, mass
        self.rows = rows[:, mass]
        self.tails = _tails(self.rows, step)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, rows: np.ndarray, tile: int) -> None:
        """A block of candidates, which is turned to one row for each dimension."""
        columns = np.ascontiguousarray(rows[:, self.mass].T)
        tails = _tails(columns.T, self.step)
        for low in range(0, len(self.ids), tile):
            self._tile(np.arange(low, min(len(self.ids), low + tile)), ids, columns, tails)

    def _tile(self, q: np.ndarray, ids: np.ndarray, columns: np.ndarray, tails: np.ndarray) -> None:
        least = self.scores[q, -1]
        alive = np.arange(len(ids))  # candidates that some query of the tile may want
        total = np.zeros((len(q), len(ids)))
        blocks = tails.shape[1]
        for b in range(blocks):
            low, high = b * self.step, min((b + 1) * self.step, len(columns))
            total += self.rows[q, low:high] @ columns[low:high, alive]
            if b + 1 < blocks:
                # a hair wider than the bound, for rounding
                bound = np.outer(self.tails[q, b + 1], tails[alive, b + 1]) * (1 + 1e-9) + 1e-6
                keep = (total + bound >= least[:, None]).any(0)
                if not keep.all():
                    alive, total = alive[keep], total[:, keep]
                if not len(alive):
                    return
        want = total >= least[:, None]
        want &= ids[alive][None, :] != self.ids[q][:, None]
        for i in np.flatnonzero(want.any(1)):
            mine = np.flatnonzero(want[i])
            scores = np.concatenate([self.scores[q[i]], total[i, mine]])
            names = np.concatenate([self.found[q[i]], ids[alive[mine]]])
            order = np.lexsort((names, -scores))[: self.k]
            self.scores[q[i]], self.found[q[i]] = scores[order], names[order]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        real = np.isfinite(self.scores)
        return np.repeat(self.ids, real.sum(1)), self.found[real], self.scores[real]


def _search(queries: list[tuple[np.ndarray, np.ndarray]], k: int, block: int, step: int, tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {rows.shape[1]: Best(ids, rows, k, step) for ids, rows in queries}
        for batch in batches:
            for ids, rows in _matrices(batch):
                if (own := best.get(rows.shape[1])) is not None:
                    for low in range(0, len(ids), block):
                        own.add(ids[low : low + block], rows[low : low + block], tile)
        for own in best.values():
            query, found, scores = own.results()
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(found), pa.array(scores.astype(np.int64))],
                names=["query_id", "vec_id", "score"],
            )

    return run


def _waves(queries: DataFrame, wave: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """The queries in waves of at most so many rows; each wave alone is on the driver."""
    ids: list[int] = []
    rows: list[list[int]] = []

    def grouped() -> list[tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(r) for r in rows])
        return [
            (
                np.array(ids, np.int64)[sizes == n],
                np.array([r for r in rows if len(r) == n], np.float64),
            )
            for n in np.unique(sizes)
        ]

    for row in queries.toLocalIterator():
        ids.append(row["vec_id"])
        rows.append(row["v"])
        if len(ids) == wave:
            yield grouped()
            ids, rows = [], []
    if ids:
        yield grouped()


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    wave: int = WAVE,
    block: int = BLOCK,
    step: int = STEP,
    tile: int = TILE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest inner product."""
    spark = vectors.sparkSession
    candidates = quantised(vectors, scale)
    queries = candidates.where(is_query).dropDuplicates(["vec_id"])
    schema = "query_id long, vec_id long, score long"
    scratch, found = Scratch(), spark.createDataFrame([], f"{schema}, rank int")
    for one in _waves(queries, wave):
        shared = spark.sparkContext.broadcast(one)  # at most `wave` rows

        def run(batches, shared=shared):
            yield from _search(shared.value, k, block, step, tile)(batches)

        # written before the next wave is drawn; only one is on the driver and in the tasks
        part = scratch.write(_ranked(candidates.mapInArrow(run, schema), k), "wave")
        shared.destroy()
        found = found.unionAll(part)
    return found.select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query, with their rank; first within groups of tasks."""
    found = found.withColumn("task", F.spark_partition_id() % 64)
    order = [F.desc("score"), F.asc("vec_id")]
    for keys in (["query_id", "task"], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "vec_id", "score", "rank")
