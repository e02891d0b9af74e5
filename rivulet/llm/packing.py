"""Best-fit decreasing packing of token pieces into sequences.

Documents become pieces of at most `capacity` tokens; only longer documents are cut. The
pieces are packed largest first, each into the open sequence with the least room that
still fits, a new sequence where none does. Lengths are whole numbers up to the capacity,
so the state of the algorithm is how many open sequences have each remaining room: a
segment tree over the rooms finds the tightest in logarithmic time, and pieces of one
length are placed together, run by run. The plan is made from the counts by length alone
(at most `capacity` numbers, whatever the corpus) and says, for pieces of a length with
ranks from a to b, in which sequences they go and at which offset. Ranks come from counts
by task and length, added up by a window over tasks; each piece then finds its place by
binary search in the plan. No piece goes through the driver, and no length, however
common, through one task.

Defined cases: a null or empty text is its end id alone. Repeated rows are packed one by
one, so rows of one doc_id are told apart by place only. An empty table has no pieces.
Other columns are neither read nor touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm import tokens, words as W
from rivulet.session import scratch_path

CAPACITY = 2048
END = 0

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"


class Rooms:
    """Segment tree over remaining rooms: runs of sequences with each room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = [0] * (2 * self.size)  # sequences below each node
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, count)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.size
        while node:
            self.some[node] += n
            node >>= 1

    def push(self, room: int, first: int, n: int) -> None:
        self.runs.setdefault(room, []).append((first, n))
        self._add(room, n)

    def pop(self, room: int) -> tuple[int, int]:
        first, n = self.runs[room].pop()
        self._add(room, -n)
        return first, n

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least so much that some sequence has."""
        node = least + self.size
        if self.some[node]:
            return least
        while node > 1:  # up to the first right neighbour with sequences, then down
            if not node & 1 and self.some[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.some[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset), in order.

    Pieces of a length fill the tightest room one after the other: after one is placed,
    its sequence has the tightest room left, until it holds no more of that length.
    """
    rooms, rows, opened = Rooms(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                each = capacity // length
                first, n, room = opened, max(1, left // each), capacity
                opened += n
            else:
                first, n = rooms.pop(room)
                each = room // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, each, first, capacity - room))
                rooms.push(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:  # one more sequence takes what is left, the rest stay as they were
                if left:
                    rows.append((length, rank, left, first + full, capacity - room))
                    rooms.push(room - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                if full < n:
                    rooms.push(room, first + full, n - full)
    return np.array(rows, np.int64).reshape(-1, 5)


def place(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of given lengths and ranks."""
    order = np.lexsort((table[:, 1], table[:, 0]))
    table = table[order]
    base = int(table[:, 1].max(initial=0)) + int(rank.max(initial=0)) + 1
    keys = table[:, 0].astype(object) * base + table[:, 1] if base > 1 << 50 else table[:, 0] * base + table[:, 1]
    row = table[np.searchsorted(keys, length * base + rank, "right") - 1]
    ahead = rank - row[:, 1]
    return row[:, 3] + ahead // row[:, 2], row[:, 4] + ahead % row[:, 2] * length


def cut(docs: DataFrame, file: str | None = None, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents; place counts the pieces of one length in their task."""
    file = file or tokens.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(file)
        width, tail = encoder.dtype.itemsize, np.array([end], encoder.dtype).tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in W.slices(batches, most=tokens.SLICE_BYTES):
            rows = []
            encoded = encoder.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.frombuffer(ids + tail, encoder.dtype).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    n = len(part)
                    rows.append((doc_id, k, start, n, zlib.crc32(part.tobytes()), task, int(seen[n])))
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[x.split()[0] for x in _PIECE.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _PIECE)


def pack(
    docs: DataFrame, file: str | None = None, end: int = END, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    cut(docs, file, end, capacity).write.parquet(path)
    pieces = spark.read.parquet(path)
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # one row for each length and task, and of a window for one length one for each task
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(
        "length", "task", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")).alias("base")
    )
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(plan(counts, capacity))  # bounded by the capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = place(table.value, length, rank)
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank")
    )
    return ranked.mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
