"""Token counts; huge documents in overlapping chunks, spliced at stable boundaries.

A document of at most `huge` characters is encoded where it is read. A longer one is cut
into chunks that overlap, dealt out over all tasks, and each chunk is encoded with the
offsets of its pieces. A piece is what the tokenizer's pattern cuts off; ids never cross
pieces. The pattern looks ahead, never back, so once two scans have a piece border at the
same place they agree from there on. A border in the overlap of two neighbours is proven
stable when the earlier chunk has it ahead of what its own end can disturb (the last
character, and a special token's string cut in two) and the later chunk has it too. The
first such border is the splice: the earlier chunk's ids up to it and the later chunk's
from it on. Seams without one are tried again with twice the overlap, up to the end of
the document, which always is a border of both.

Counts of a chunk are kept as ids up to each border in its overlaps, so a seam is a join
of a few hundred numbers; texts are moved only for huge documents, one row for each
distinct text.

Defined cases: a null or empty text has no tokens and no bytes. A special token's string
in a text is that special token, as the library has it. Repeated rows give repeated rows;
other columns are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import tokens, words as W
from rivulet.session import scratch_path

HUGE = 65_536  # characters
CHUNK = 16_384
OVERLAP = 512


def _small(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(file)
        width = encoder.dtype.itemsize
        for batch in W.slices(batches, most=tokens.SLICE_BYTES):
            texts = batch.column("text")
            found = [len(ids) // width for ids in encoder.encode(texts.to_pylist())]
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), sizes, pa.array(found, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def _cut(chunk: int, overlap: int):
    """Chunks of a text: chunk i starts at i * chunk and runs into the next by overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            for key, text in zip(keys, texts, strict=True):
                n = -(-len(text) // chunk)
                for low in range(0, n, 64):
                    part = range(low, min(n, low + 64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(part), pa.string()),
                            pa.array(part, pa.int32()),
                            pa.array([i + 1 == n for i in part], pa.bool_()),
                            pa.array([(i + 1) * chunk + overlap >= len(text) for i in part]),
                            pa.array([text[i * chunk : (i + 1) * chunk + overlap] for i in part]),
                        ],
                        names=["key", "chunk", "last", "whole", "text"],
                    )

    return run


def _borders(file: str, chunk: int, overlap: int):
    """Of each chunk: its seam with the next (side 0) and with the one before (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(file)
        margin = max([1, *map(len, encoder.special)])
        for batch in W.slices(batches):
            rows = []
            for key, i, last, whole, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                ends, ids = encoder.spans(text)
                ends = np.concatenate(([0], ends)) + i * chunk
                ids = np.concatenate(([0], ids))
                total = int(ids[-1])
                if not last:  # borders that this chunk's end can't disturb
                    stop = (i * chunk + len(text)) - (0 if whole else margin)
                    own = (ends >= (i + 1) * chunk) & (ends <= stop)
                    rows.append((key, i, 0, ends[own], ids[own], None))
                if i:
                    reach = i * chunk + overlap
                    if last or whole:  # the end of the text is a border too
                        reach = max(reach, i * chunk + len(text))
                    own = ends <= reach
                    rows.append((key, i - 1, 1, ends[own], ids[own], None))
                if last:
                    rows.append((key, i, 2, ends[:0], ids[:0], total))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.string(), pa.int32(), pa.int32()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["key", "seam", "side", "place", "ids", "total"],
            )

    return run


def _spliced(texts: DataFrame, file: str, chunk: int, overlap: int) -> DataFrame:
    """key, seam, part: what the seam adds to the count, null where nothing fits."""
    chunks = texts.mapInArrow(
        _cut(chunk, overlap), "key string, chunk int, last boolean, whole boolean, text string"
    ).repartition(F.col("key"), F.col("chunk"))
    borders = chunks.mapInArrow(
        _borders(file, chunk, overlap),
        "key string, seam int, side int, place array<long>, ids array<long>, total long",
    )
    ends = borders.where("side = 2").select("key", F.lit(-1).alias("seam"), F.col("total").alias("part"))
    sides = borders.where("side < 2").select(
        "key", "seam", "side", F.explode(F.arrays_zip("place", "ids")).alias("at")
    )
    meet = (
        sides.groupBy("key", "seam", F.col("at.place").alias("place"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.when(F.col("side") == 0, F.col("at.ids")).otherwise(-F.col("at.ids"))).alias("part"),
        )
        .groupBy("key", "seam")
        .agg(F.min(F.when(F.col("n") == 2, F.struct("place", "part"))).alias("first"))
    )
    return ends.unionAll(meet.select("key", "seam", F.col("first.part").alias("part")))


def count(
    docs: DataFrame,
    file: str | None = None,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document under a tokenizer file.

    The file's tokenizer must have no normalizer, since offsets must be those of the text.
    """
    spark = docs.sparkSession
    file = file or tokens.path("byte_bpe_50k.json")
    docs = docs.select("doc_id", "text")
    long = F.length("text") > huge
    small = docs.where(F.col("text").isNull() | ~long).mapInArrow(
        _small(file), "doc_id long, n_bytes long, n_tokens long"
    )
    large = docs.where(long).withColumn("key", F.sha2("text", 256))
    texts = large.select("key", "text").dropDuplicates(["key"])
    done = []
    while True:
        path = scratch_path(spark, "seams")
        _spliced(texts, file, chunk, overlap).write.parquet(path)
        found = spark.read.parquet(path)
        failed = found.where("part is null").select("key").distinct()
        if done:  # earlier rounds keep the keys that went well
            done.append(found)
        else:
            done = [found]
        if failed.isEmpty():
            break
        overlap *= 2
        texts = large.select("key", "text").join(failed, "key", "left_semi").dropDuplicates(["key"])
    counts = done[0]
    for later in done[1:]:
        counts = counts.join(later.select("key").distinct(), "key", "left_anti").unionAll(later)
    counts = counts.groupBy("key").agg(F.sum("part").alias("n_tokens"))
    sizes = large.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    return small.unionAll(
        sizes.join(counts, "key").select(
            F.col("doc_id").cast("long"), "n_bytes", "n_tokens"
        )
    )
