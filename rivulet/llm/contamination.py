"""Benchmark decontamination by suffix arrays over the training documents.

Each task turns slices of its documents into shards and sorts every word position of a
shard into suffix order, two words at a time. Every suffix of a benchmark item that can
start a window is binary-searched in every shard; the order is refined by two more words
only inside the ranges that some benchmark suffix has reached, so a shard costs one sort
of its positions and little else. What is left at the depth of the window is compared
word by word and chained along the item into the longest verbatim matches.

The benchmark is cut into blocks of a bounded number of words; one block at a time goes
to the tasks, and each block is searched in all documents; the result of a pass is written
before the arrays of the next block are made. Documents are never shuffled or gathered: one
pass for each block.

Defined cases: a null or empty text has no words and is never contaminated; so does a
null item. An item shorter than the window is one window; an item without words is
skipped. Repeated documents are judged one by one; of repeated item ids every row
counts under its id. A null item id is searched, and listed as null only in `matches`.
An empty benchmark leaves all documents clean. Other columns are neither read nor
touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import words as W
from rivulet.llm.scratch import Scratch

WINDOW = 10
BLOCK_WORDS = 1 << 20

MATCH = "array<struct<item_id:long,item_word:int,doc_word:int,length:int>>"
SCHEMA = (
    "doc_id long, n_words long, n_hit long, items array<long>, "
    f"spans array<struct<start:int,end:int>>, matches {MATCH}"
)
_MATCH = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("item_word", pa.int32()),
            ("doc_word", pa.int32()),
            ("length", pa.int32()),
        ]
    )
)
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


@dataclass
class Suffixes:
    """Benchmark suffixes that start a window, with the words of their items."""

    words: np.ndarray  # hashes of all items, one after the other, 16 spare ones behind
    at: np.ndarray  # place of each suffix in words
    depth: np.ndarray  # words of its window
    item: np.ndarray  # row of its item
    item_word: np.ndarray
    item_id: list


def suffixes(ids: list, texts: list, window: int = WINDOW) -> Suffixes:
    alphabet = W.alphanumeric()
    split = W.split(pa.array(texts, pa.string()), alphabet)
    hashes = split.hashes(alphabet)
    counts = split.counts
    depth = np.minimum(counts, window)
    starts = np.where(counts > 0, counts - depth + 1, 0)
    item = np.repeat(np.arange(len(ids)), starts)
    within = np.arange(len(item)) - np.repeat(np.cumsum(starts) - starts, starts)
    return Suffixes(
        np.concatenate([hashes, np.zeros(window + 2, np.uint64)]),
        split.first[:-1][item] + within,
        depth[item],
        item,
        within,
        list(ids),
    )


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """16 bits of a word and 16 bits of the next: the order of the suffix array."""
    top = hashes >> np.uint64(48)
    return (top[:-1] << np.uint64(16)) | top[1:]


def search(hashes: np.ndarray, stop: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """All (position, suffix) where the shard has the window of a benchmark suffix.

    hashes are the words of a shard, stop the end of the document of each.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(hashes) or not len(tests.at):
        return none
    shard, keys = np.concatenate([hashes, np.zeros(2, np.uint64)]), None
    pair, test_pair = _pairs(shard), _pairs(tests.words)
    keys = np.sort((pair[: len(hashes)] << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64))
    order, level = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32)
    # at depth 0 there is one range; then one for each pair that a benchmark suffix has
    group, alive = np.zeros(len(tests.at), np.int64), np.arange(len(tests.at))
    found_at, found_test = [], []
    for depth in range(0, int(tests.depth.max()), 2):
        want = test_pair[tests.at[alive] + depth]
        single = tests.depth[alive] - depth == 1
        base = group[alive].astype(np.uint64) << np.uint64(32)
        low_word = np.where(single, want & np.uint64(0xFFFF0000), want)
        high_word = np.where(single, want | np.uint64(0xFFFF), want)
        low = np.searchsorted(level, base | low_word, "left")
        high = np.searchsorted(level, base | high_word, "right")
        some = high > low
        alive, low, high, single = alive[some], low[some], high[some], single[some]
        if not len(alive):
            break
        done = tests.depth[alive] - depth <= 2
        for suffix, a, b in zip(alive[done], low[done], high[done], strict=True):
            found_at.append(order[a:b].astype(np.int64))
            found_test.append(np.full(b - a, suffix))
        alive, low, high = alive[~done], low[~done], high[~done]
        if not len(alive):
            break
        # refine the ranges reached by the next two words
        ranges, first, which = np.unique(low, return_index=True, return_inverse=True)
        sizes = high[first] - ranges
        where = np.repeat(ranges - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        place = order[where].astype(np.int64) + depth + 2
        label = np.repeat(np.arange(len(ranges), dtype=np.uint64), sizes) << np.uint64(32)
        fits = place < len(hashes)
        place, label = place[fits], label[fits]
        key = label | pair[place]
        arranged = np.argsort(key, kind="stable")
        order = (place[arranged] - (depth + 2)).astype(np.uint64)
        level = key[arranged]
        group[alive] = which
    at, test = _joined(found_at, found_test)
    keep = at + tests.depth[test] <= stop[at]
    at, test = at[keep], test[keep]
    for k in range(int(tests.depth.max())):  # the words themselves
        inside = k < tests.depth[test]
        same = ~inside | (shard[np.minimum(at + k, len(hashes))] == tests.words[tests.at[test] + k])
        at, test = at[same], test[same]
    return at, test


def _joined(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b).astype(np.int64)


def chains(at: np.ndarray, test: np.ndarray, tests: Suffixes) -> np.ndarray:
    """Hits that follow each other in document and item, as rows (at, suffix, length)."""
    item, word = tests.item[test], tests.item_word[test]
    order = np.lexsort((at, at - word, item))
    at, test, item, word = at[order], test[order], item[order], word[order]
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (word[1:] != word[:-1] + 1)
    begin = np.flatnonzero(new)
    run = np.diff(np.append(begin, len(at)))
    return np.stack([at[begin], test[begin], run - 1 + tests.depth[test[begin]]], 1)


def _hits(batch: pa.RecordBatch, tests: Suffixes, alphabet: W.Alphabet):
    """Of one slice: words of each document, hit words, first words, matches by document."""
    split = W.split(batch.column("text"), alphabet)
    at, test = search(split.hashes(alphabet), split.stop(), tests)
    edge = np.zeros(len(split.start) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + tests.depth[test], -1)
    covered = np.cumsum(edge[:-1]) > 0
    found: dict[int, list] = {}
    if len(at):
        runs = chains(at, test, tests)
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        documents = np.searchsorted(split.first, runs[:, 0], "right") - 1
        for d, (a, t, length) in zip(documents.tolist(), runs.tolist(), strict=True):
            found.setdefault(d, []).append(
                {
                    "item_id": tests.item_id[tests.item[t]],
                    "item_word": int(tests.item_word[t]),
                    "doc_word": a - int(split.first[d]),
                    "length": length,
                }
            )
    return split.counts, covered, split.first, found


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list, list]]:
    """Benchmark items in blocks of about so many words, one at a time; at least one."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "") // 2 + 1
        if size >= block_words:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document: its words, hit words, items, hit spans and longest verbatim matches."""
    found = docs.select("doc_id", "text").withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "n_hit": F.lit(0).cast("long"),
            "items": F.array().cast("array<long>"),
            "spans": F.array().cast("array<struct<start:int,end:int>>"),
            "matches": F.array().cast(MATCH),
        }
    )
    scratch = Scratch()
    for place, (ids, texts) in enumerate(_blocks(benchmark, block_words)):
        if place:  # a pass has run before the arrays of the next block are made
            found = scratch.write(found, "matches")
        found = found.mapInArrow(_pass(suffixes(ids, texts, window)), f"text string, {SCHEMA}")
    return found.drop("text")


def _pass(tests: Suffixes):
    """Adds what one block of the benchmark finds to what earlier blocks have found."""

    def run(batches):
        alphabet = W.alphanumeric()
        for batch in W.slices(batches):
            counts, covered, first, found = _hits(batch, tests, alphabet)
            n_hit, items, spans, matches = [], [], [], []
            before = [batch.column(name).to_pylist() for name in ("items", "spans", "matches")]
            for d, (old_items, old_spans, old) in enumerate(zip(*before, strict=True)):
                if d not in found:
                    spans.append(old_spans)
                    items.append(old_items)
                    matches.append(old)
                    n_hit.append(sum(s["end"] - s["start"] for s in old_spans))
                    continue
                hit = np.zeros(counts[d] + 2, np.int8)
                hit[1:-1] = covered[first[d] : first[d + 1]]
                for span in old_spans:
                    hit[1 + span["start"] : 1 + span["end"]] = 1
                edges = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
                spans.append([{"start": int(x), "end": int(y)} for x, y in edges])
                n_hit.append(int(hit.sum()))
                ids = {m["item_id"] for m in found[d]} - {None}
                items.append(sorted(ids | set(old_items)))
                matches.append(old + found[d])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text"),
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.int64())),
                    pa.array(spans, _SPAN),
                    pa.array(matches, _MATCH),
                ],
                names=["text", "doc_id", "n_words", "n_hit", "items", "spans", "matches"],
            )

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents without any benchmark window; all their columns as they were."""
    scratch = Scratch()
    for place, (ids, texts) in enumerate(_blocks(benchmark, block_words)):
        if place:
            docs = scratch.write(docs, "clean")
        tests = suffixes(ids, texts, window)

        def run(batches, tests=tests):
            alphabet = W.alphanumeric()
            for batch in W.slices(batches):
                found = _hits(batch, tests, alphabet)[3]
                yield batch.filter(pa.array([d not in found for d in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
