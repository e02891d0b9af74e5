"""Words of many texts at once, as 64-bit hashes over Arrow buffers.

A text is looked at as UTF-8 bytes. A byte table says which bytes belong to words and
gives each byte a 64-bit value (letters may be folded); a word's hash is a polynomial
in its bytes, an n-gram's hash mixes those of its words. All of it is numpy over a
slice of a few megabytes, so memory stays bounded whatever the size of a batch; a
single longer text is one slice of its own, hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_POW = _powers(_BASE, PIECE_BYTES + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), PIECE_BYTES + 1)
_VALUES = np.random.Generator(np.random.PCG64(20260)).integers(1, 1 << 63, 256).astype(
    np.uint64
) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, in place."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xA0761D6478BD642F)
        x ^= x >> np.uint64(32)
    return x


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = a * np.uint64(0x9FB21C651E98DF25)
        out += b
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += np.uint64(salt)
        out ^= out >> np.uint64(29)
    return out


def ngrams(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every n consecutive words; empty when there are fewer than n."""
    if len(words) < n:
        return words[:0].copy()
    out, done, power, width = None, 0, words, 1
    rest = n
    while rest:
        if rest & 1:
            part = power[done : len(words) - (width - 1)] if done else power
            if out is None:
                out = part
            else:
                size = min(len(out), len(part))
                out = _pair(out[:size], part[:size], seed * 2 + 1)
            done += width
        rest >>= 1
        if rest:
            power = _pair(power[:-width], power[width:], seed * 2 + width * 7919 + 3)
            width *= 2
    return mix(out[: len(words) - n + 1].copy())


@dataclass(frozen=True)
class Alphabet:
    """Which bytes make words, and which value each byte has in a hash."""

    inside: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(inside: np.ndarray, fold: bool) -> "Alphabet":
        values = _VALUES.copy()
        if fold:
            values[65:91] = values[97:123]
        return Alphabet(inside, values)


def alphanumeric() -> Alphabet:
    """[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return Alphabet.of(inside, fold=True)


def blank_separated(fold: bool) -> Alphabet:
    """[^\\x20\\x09-\\x0D]+, of the text as it is or with A-Z lower-cased."""
    inside = np.ones(256, bool)
    inside[32] = inside[9:14] = False
    return Alphabet.of(inside, fold)


@dataclass
class Words:
    """The words of a slice of texts: document d has words first[d] to first[d + 1]."""

    buffer: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # byte offset of each text, one more than texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def stop(self) -> np.ndarray:
        """The end, in words, of the document of each word."""
        return np.repeat(self.first[1:], self.counts)

    def hashes(self, alphabet: Alphabet, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; another seed gives an independent hash."""
        values = alphabet.values
        if seed:
            values = mix(values + np.uint64(seed)) | np.uint64(1)
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            low = self.start[at]
            to = int(np.searchsorted(self.end, low + PIECE_BYTES, "right"))
            if to <= at:  # a word longer than a piece
                out[at] = self._long(int(low), int(self.end[at]), values)
                at += 1
                continue
            high = self.end[to - 1]
            with np.errstate(over="ignore"):
                sums = np.zeros(high - low + 1, np.uint64)
                terms = values[self.buffer[low:high]]
                terms *= _POW[: high - low]
                np.cumsum(terms, out=sums[1:])
                begin = self.start[at:to] - low
                out[at:to] = (sums[self.end[at:to] - low] - sums[begin]) * _INV[begin]
            at = to
        return mix(out)

    def _long(self, low: int, high: int, values: np.ndarray) -> np.uint64:
        total, scale = 0, 1
        step = pow(_BASE, PIECE_BYTES, 1 << 64)
        for at in range(low, high, PIECE_BYTES):
            part = values[self.buffer[at : min(high, at + PIECE_BYTES)]]
            with np.errstate(over="ignore"):
                piece = int((part * _POW[: len(part)]).sum(dtype=np.uint64))
            total = (total + piece * scale) % (1 << 64)
            scale = scale * step % (1 << 64)
        return np.uint64(total)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(where):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[where[0] : where[-1]], where - where[0]


def split(texts: pa.Array, alphabet: Alphabet) -> Words:
    buffer, offsets = text_buffer(texts)
    inside = alphabet.inside[buffer]
    edge = np.empty(len(buffer), bool)  # a word may start: another kind or text before
    if len(buffer):
        edge[0] = True
        np.logical_not(inside[:-1], out=edge[1:])
        edge[offsets[:-1][offsets[:-1] < len(buffer)]] = True
        start = np.flatnonzero(inside & edge)
        edge[-1] = True
        np.logical_not(inside[1:], out=edge[:-1])
        last = offsets[1:] - 1
        edge[last[last >= 0]] = True
        end = np.flatnonzero(inside & edge) + 1
    else:
        start = end = np.empty(0, np.int64)
    return Words(buffer, offsets, start, end, np.searchsorted(start, offsets))


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of Spark's batches in slices of few bytes of text, one row at least."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(total, total[at] + most, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
