"""Hashed text features and linear models for the classifiers.

A model is fitted on the driver on a sample whose size is a parameter; the sample is
featurised in the tasks and only sparse features travel. Scoring is one pass over the
documents with the weights, which are as many as hash buckets, broadcast.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import words as W

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)  # bytes of a word's beginning


def letters() -> W.Alphabet:
    """Words of letters, ASCII ones lower-cased, and all bytes beyond ASCII."""
    inside = np.zeros(256, bool)
    inside[65:91] = inside[97:123] = inside[128:] = True
    return W.Alphabet.of(inside, fold=True)


def buckets(texts: pa.Array, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the words and word beginnings of each text, and their bounds."""
    alphabet = letters()
    split = W.split(texts, alphabet)
    document = split.document()
    found = [(document, split.hashes(alphabet))]
    for n in PREFIXES:
        longer = np.flatnonzero(split.end - split.start > n)
        begin = W.Words(
            split.buffer, split.offsets, split.start[longer], split.start[longer] + n, split.first
        )
        found.append((document[longer], begin.hashes(alphabet, n)))
    rows = np.concatenate([d for d, _ in found]).astype(np.uint64)
    places = np.concatenate([h >> np.uint64(64 - 18) if size == BUCKETS else h % np.uint64(size) for _, h in found])
    keys = np.unique((rows << np.uint64(32)) | places)
    bounds = np.searchsorted(keys >> np.uint64(32), np.arange(len(texts) + 1))
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), bounds


def crc32_fold(column: str = "doc_id") -> "F.Column":
    """crc32 of an id written as text, modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def sample(rows: DataFrame, most: int) -> DataFrame:
    """At most so many rows, the same ones whatever the partitions: by a hash of the id."""
    order = F.xxhash64(F.lit(11), "doc_id")
    return rows.orderBy(order, "doc_id", F.xxhash64("text")).limit(most)


def stable_fold(ids: list, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(f"fold {i}".encode()) % folds for i in ids])
