"""Substring deduplication over content-marked phrases and their earlier references.

Whether a stretch repeats is decided by hashes of phrases and of windows; the factors of
a relative Lempel-Ziv parse are put together from what those find (step 3), so this is
not the parse itself, which would factor each document against the words of a reference.

A window is WINDOW consecutive words of one document. Words covered by a window whose
words also start earlier in the corpus (a smaller doc_id, or the same document and an
earlier place) are removed; all windows are judged on the input.

Every document is cut into phrases by its content: each window is marked by the smallest
of its SEED-grams, and consecutive windows with the same mark make a phrase. Equal
stretches of text so have the same phrases, but for the ones at their ends. The index
holds phrases by mark, dealt into reference blocks by the mark's hash, so each phrase
meets every reference block that can hold an earlier copy and no other.

Parsing takes three steps, all on phrases that share their mark with another one:

1. whole phrases: of phrases with the same words the earliest is the reference, every
   other is a factor copied from it (pre-aggregated, so a phrase that fills a third of
   the corpus costs one row for each task);
2. factor borders: references that share a mark without being equal are read once more
   and checked window by window against the references of their mark, for a match may
   end inside a phrase;
3. greedy parse: per document the matches are put together left to right, each factor as
   long as matches that continue each other in their source allow; factors of at least a
   window become duplicate spans.

The texts themselves are moved twice, by document: to read the references of step 2,
and to cut the spans out. Marks, phrases and windows have 64-bit hashes of independent
seeds, which must agree together (128 bits or more).

Defined cases: a null or empty text has no words; a document shorter than the window has
no windows. Null doc_ids count as earlier than all others. Rows that share a doc_id are
told apart by their text, in the order of its hash; rows equal in both are one document
and keep the same words. Where ids are null or repeated, `source` of a factor is the
document's number in that order. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import words as W
from rivulet.session import scratch_path

WINDOW = 20
SEED = 8

_PHRASE = "doc long, at int, n int, mark long, phrase long"


def _mins(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every `width` consecutive values, the first of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place = values[:n].copy(), np.arange(n)
    for k in range(1, width):
        other = values[k : k + n]
        less = other < best
        best[less] = other[less]
        place[less] = np.flatnonzero(less) + k
    return place


def phrases(split: W.Words, hashes: np.ndarray, window: int = WINDOW, seed: int = SEED):
    """Of a slice: first window, number of windows, mark and hash of every phrase."""
    stop = split.stop()
    grams = W.ngrams(hashes, seed, 1)
    place = _mins(grams, window - seed + 1)
    starts = np.flatnonzero(np.arange(len(place)) + window <= stop[: len(place)])
    if not len(starts):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    mark = place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    at = starts[first]
    # words at .. at + n + window - 1, mixed with where the mark stands among them
    whole = W.ngrams(hashes, window, 2)
    with np.errstate(over="ignore"):
        terms = whole[starts] * (np.arange(len(starts)) - np.repeat(first, n) + 1).astype(np.uint64) ** 3
        ends = np.cumsum(terms)[np.append(first[1:], len(starts)) - 1]
        total = np.diff(ends, prepend=np.uint64(0))
        total += n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return at, n, grams[place[at]].view(np.int64), W.mix(total).view(np.int64)


def _index(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = W.blank_separated(fold=False)
        for batch in W.slices(batches):
            split = W.split(batch.column("text"), alphabet)
            at, n, mark, phrase = phrases(split, split.hashes(alphabet), window, seed)
            d = np.searchsorted(split.first, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array(d)),
                    pa.array((at - split.first[d]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(mark),
                    pa.array(phrase),
                ],
                names=["doc", "at", "n", "mark", "phrase"],
            )

    return run


def _windows(window: int):
    """Windows first .. first + n - 1 of a document, two hashes and the place of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = W.blank_separated(fold=False)
        for batch in W.slices(batches):
            split = W.split(batch.column("text"), alphabet)
            one = W.ngrams(split.hashes(alphabet), window, 3)
            two = W.ngrams(split.hashes(alphabet, 77), window, 4)
            lists = batch.column("found")
            flat = lists.flatten()
            at, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
            d = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(at)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            place = at[row] + step
            where = split.first[d[row]] + place
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one[where].view(np.int64)),
                    pa.array(two[where].view(np.int64)),
                    batch.column("doc").take(pa.array(d[row])),
                    pa.array(place.astype(np.int32)),
                    pa.array(at[row].astype(np.int32)),
                ],
                names=["one", "two", "doc", "place", "at"],
            )

    return run


def parse(rows: list, window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Greedy factors (first word, words, source document, source word) of one document.

    rows are matches (first window, windows, source document, source window). At each
    word the factor that reaches farthest is taken; matches that go on where another
    ends, in the source as well, are one factor.
    """
    joined: list[list] = []
    open_at: dict[tuple, list] = {}
    for at, n, source, there in sorted(rows, key=lambda r: (r[0], -r[1])):
        key = (source, there - at)
        last = open_at.get(key)
        if last is not None and at <= last[0] + last[1]:
            last[1] = max(last[1], at + n - last[0])
            continue
        open_at[key] = last = [at, n, source, there]
        joined.append(last)
    out, reach, k = [], -1, 0
    joined.sort(key=lambda r: r[0])
    while k < len(joined):
        best = None
        while k < len(joined) and joined[k][0] <= reach:  # can go on where we are
            if best is None or joined[k][0] + joined[k][1] > best[0] + best[1]:
                best = joined[k]
            k += 1
        if best is None or best[0] + best[1] <= reach:
            if k == len(joined):
                break
            best = joined[k]
            k += 1
        at, n, source, there = best
        if at + n > reach:
            out.append((at, n + window - 1, source, there))
            reach = at + n
    return out


def _written(rows: DataFrame, label: str) -> DataFrame:
    """The rows by way of a table in the shared folder, which cuts their lineage."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


_FACTOR = "array<struct<at:int,n:int,source:long,there:int>>"


def matches(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc, at, n, source, there: stretches of windows that start earlier elsewhere.

    docs has doc (its order is the order of the corpus) and text.
    """
    indexed = docs.mapInArrow(_index(window, seed), _PHRASE)
    # Counted keys are written ahead of their joins: a join on a table that is read has
    # exchanges of its own on both sides, whose hot partitions Spark can split.
    shared = _written(
        indexed.groupBy("mark").agg(F.count("*").alias("times")).where("times > 1").select("mark"),
        "marks",
    )
    found = _written(indexed.join(shared, "mark", "left_semi"), "phrases")
    # 1. whole phrases
    references = found.groupBy("mark", "phrase").agg(
        F.min(F.struct("doc", "at")).alias("first"), F.min("n").alias("n")
    )
    references = _written(references.select("mark", "phrase", "first.*", "n"), "references")
    source = references.select(
        "mark", "phrase", F.col("doc").alias("source"), F.col("at").alias("there")
    )
    copied = found.join(source, ["mark", "phrase"]).where(
        ~(F.col("doc").eqNullSafe(F.col("source")) & (F.col("at") == F.col("there")))
    )
    # 2. borders: references that share a mark with another one
    several = _written(
        references.groupBy("mark").agg(F.count("*").alias("times")).where("times > 1").select("mark"),
        "several",
    )
    unsure = (
        references.join(several, "mark", "left_semi")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("at", "n")).alias("found"))
    )
    windows = docs.join(unsure, "doc").mapInArrow(
        _windows(window), "one long, two long, doc long, place int, at int"
    )
    windows = _written(windows, "windows")
    earliest = _written(
        windows.groupBy("one", "two")
        .agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select("one", "two", F.col("first.doc").alias("source"), F.col("first.place").alias("there")),
        "earliest",
    )
    crossed = windows.join(earliest, ["one", "two"]).where(
        ~(F.col("doc").eqNullSafe(F.col("source")) & (F.col("place") == F.col("there")))
    )
    columns = ["doc", "at", "n", "source", "there"]
    return copied.select(columns).unionAll(
        crossed.select(
            "doc", F.col("place").alias("at"), F.lit(1).alias("n"), "source", "there"
        )
    )


def _cut(window: int):
    """Factors and kept words of documents with their matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            names, counts, removed, kept, factors = [], [], [], [], []
            for text, rows in zip(
                batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True
            ):
                split = (text or "").encode().split()
                parsed = parse([(r["at"], r["n"], r["source"], r["there"]) for r in rows or ()], window)
                if parsed:
                    drop = np.zeros(len(split) + 1, np.int32)
                    for at, n, _, _ in parsed:
                        drop[at] += 1
                        drop[at + n] -= 1
                    keep = (np.cumsum(drop[:-1]) == 0).tolist()
                    left = [w for w, k in zip(split, keep, strict=True) if k]
                else:
                    left = split
                counts.append(len(split))
                removed.append(len(split) - len(left))
                kept.append(b" ".join(left))
                factors.append(
                    [{"at": a, "n": n, "source": s, "there": t} for a, n, s, t in parsed]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(
                        factors,
                        pa.list_(
                            pa.struct(
                                [
                                    ("at", pa.int32()),
                                    ("n", pa.int32()),
                                    ("source", pa.int64()),
                                    ("there", pa.int32()),
                                ]
                            )
                        ),
                    ),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "factors"],
            )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc: the id or, where ids are null or repeated, a number in the order of id and text."""
    doubt = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if doubt.where("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn("doc", F.col("doc_id"))
    tied = docs.withColumn("tie", F.xxhash64("text"))
    order = tied.select(F.col("doc_id").alias("id"), F.col("tie").alias("t")).distinct()
    order = order.orderBy(F.asc_nulls_first("id"), "t")
    order = _written(order.withColumn("doc", F.monotonically_increasing_id()), "order")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("t"))
    return tied.join(order, same).select("doc_id", "text", "doc")


def deduplicate(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per document: words, removed words, the kept text and its digest, and the factors."""
    keyed = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = (
        matches(keyed.select("doc", "text"), window, seed)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("at", "n", "source", "there")).alias("found"))
    )
    return keyed.join(found, "doc", "left").mapInArrow(
        _cut(window),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
        f"factors {_FACTOR}",
    )
