"""Token ids of a corpus as entropy-coded files.

A token file is a folder of two tables. `code` has the length of each id's canonical
Huffman code, from the counts of all ids of all documents. `blocks` has independent
blocks of whole documents in ascending doc_id order: which documents with how many ids
each, the bit stream, and the bit offset of every CHECKPOINT-th id, from which any
stretch can be decoded by table without the ones before it. `part` and `number` order the
blocks, `first` is the number of ids in the part before the block.

Writing: documents are dealt out by ranges of doc_id and sorted, encoded once, and
staged as plain ids; their counts (bounded by the vocabulary) make the code; a second
pass without a shuffle packs the staged blocks. All tables are written by Spark's
committers to the shared folder, so lost tasks are simply run again.

Defined cases: a null or empty text is its end id alone. Null doc_ids come first. Rows
that share a doc_id are ordered by a hash of their text, then by text, and each keeps its ids; an empty table makes a
file without blocks. Other columns are neither read nor touched. The longest document
must fit a task's memory as ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import huffman, tokens, words as W
from rivulet.session import scratch_path

END = 2  # appended to each document
BLOCK = 1 << 18  # ids
CHECKPOINT = 256

_HEAD = "part int, number int, first long, doc_ids array<long>, sizes array<int>"


def _stage(file: str, end: int, block: int):
    """Sorted documents to blocks of plain ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(file)
        tail = np.array([end], encoder.dtype).tobytes()
        part, number, first = TaskContext.get().partitionId(), 0, 0
        names, ids, held = [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = [len(x) // encoder.dtype.itemsize for x in ids]
            flat = np.frombuffer(b"".join(ids), encoder.dtype)
            times = np.bincount(flat, minlength=encoder.size)
            found = np.flatnonzero(times)
            times = times[found]
            row = [part, number, first, names, sizes, flat.astype("<u4").tobytes()]
            row += [found.tolist(), times.tolist()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            kinds += [pa.list_(pa.int32()), pa.binary()]
            kinds += [pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds, strict=True)],
                names=["part", "number", "first", "doc_ids", "sizes", "ids", "id", "times"],
            )

        for batch in W.slices(batches, most=tokens.SLICE_BYTES):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, x in zip(doc_ids, encoder.encode(batch.column("text").to_pylist()), strict=True):
                names.append(doc_id)
                ids.append(x + tail)
                held += len(x) // encoder.dtype.itemsize + 1
                if held >= block:
                    yield flush()
                    number, first = number + 1, first + held
                    names, ids, held = [], [], 0
        if names:
            yield flush()

    return run


def write(
    docs: DataFrame,
    path: str,
    file: str | None = None,
    end: int = END,
    block: int = BLOCK,
    limit: int = huffman.LIMIT,
) -> None:
    """Encode all documents and write them as a token file to a path Spark can write."""
    spark = docs.sparkSession
    file = file or tokens.path("byte_bpe_50k.json")
    staged = scratch_path(spark, "ids")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "tie", F.xxhash64("text")
    )
    (
        keyed.repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
        .mapInArrow(_stage(file, end, block), f"{_HEAD}, ids binary, id array<int>, times array<long>")
        .write.option("compression", "zstd")
        .parquet(staged)
    )
    blocks = spark.read.parquet(staged)
    counted = (
        blocks.select(F.explode(F.arrays_zip("id", "times")).alias("x"))
        .groupBy(F.col("x.id").alias("id"))
        .agg(F.sum("x.times").alias("n"))
        .toPandas()
    )
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(int)] = counted["n"].to_numpy(np.int64)
    sizes = huffman.lengths(counts, limit)
    code = pa.table({"id": pa.array(range(len(sizes)), pa.int32()), "length": pa.array(sizes, pa.int32())})
    spark.createDataFrame(code).where("length > 0").write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(sizes)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        values = huffman.codes(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), "<u4")
                stream, offsets = huffman.pack(ids, lengths, values, CHECKPOINT)
                row = row.drop_columns(["ids"])
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array([stream], pa.binary()), pa.array([offsets], pa.binary())],
                    names=[*row.schema.names, "stream", "checkpoints"],
                )

    (
        blocks.drop("id", "times")
        .mapInArrow(run, f"{_HEAD}, stream binary, checkpoints binary")
        .write.option("compression", "zstd")
        .parquet(f"{path}/blocks")
    )


def _code(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id; as many rows as the vocabulary at most."""
    code = spark.read.parquet(f"{path}/code").toPandas()
    sizes = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.uint8)
    sizes[code["id"].to_numpy(int)] = code["length"].to_numpy(np.uint8)
    return sizes


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (or their crc32) of every document of a token file."""
    shared = spark.sparkContext.broadcast(_code(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    # one row for each part: as many as tasks wrote the file
    before = {}
    total = 0
    for row in sorted(parts.toLocalIterator()):
        before[row["part"]] = total
        total += row["n"]
    offsets = spark.sparkContext.broadcast(before)
    last = "ids_crc32 long" if digest else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = huffman.Decoder(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, doc_ids, sizes, stream, checkpoints = (
                    batch.column(c)[row]
                    for c in ("part", "first", "doc_ids", "sizes", "stream", "checkpoints")
                )
                sizes = np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(sizes)
                ids = decoder.unpack(
                    stream.as_buffer(), checkpoints.as_buffer(), int(sizes.sum()), CHECKPOINT
                ).astype("<u4")
                starts = offsets.value[part.as_py()] + first.as_py() + ends - sizes
                pieces = [ids[b - n : b] for n, b in zip(sizes, ends, strict=True)]
                if digest:
                    values = pa.array([zlib.crc32(x.tobytes()) for x in pieces], pa.int64())
                else:
                    values = pa.array([x.astype(np.int32) for x in pieces], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(starts), pa.array(sizes), values],
                    names=["doc_id", "start", "n_tokens", last.split()[0]],
                )

    return blocks.select("part", "first", "doc_ids", "sizes", "stream", "checkpoints").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {last}"
    )
