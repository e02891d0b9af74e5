"""Canonical length-limited Huffman codes in numpy: lengths, codes, bit streams."""

from __future__ import annotations

import numpy as np

LIMIT = 20  # bits of the longest code; the decoding table has 2 ** LIMIT entries


def lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol, 0 where it never occurs: package-merge.

    Each round merges the symbols with pairs of the round before, cheapest first; a
    symbol's length is the number of rounds in which it is among the 2n - 2 cheapest.
    """
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols have no codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    rounds, row = [], leaves
    kinds = np.ones(len(leaves), bool)
    rounds.append(kinds)
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        kinds = np.concatenate([np.ones(len(leaves), bool), np.zeros(len(pairs), bool)])
        arranged = np.argsort(both, kind="stable")
        row, kinds = both[arranged], kinds[arranged]
        rounds.append(kinds)
    taken = 2 * len(leaves) - 2
    found = np.zeros(len(leaves), np.int64)
    for kinds in reversed(rounds):
        symbols = int(kinds[:taken].sum())
        found[:symbols] += 1
        taken = 2 * (taken - symbols)
    out[order] = found
    return out


def codes(sizes: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then by symbol."""
    out = np.zeros(len(sizes), np.uint64)
    order = np.lexsort((np.arange(len(sizes)), sizes))
    order = order[sizes[order] > 0]
    if not len(order):
        return out
    longest = int(sizes.max())
    scaled = np.uint64(1) << (longest - sizes[order]).astype(np.uint64)
    before = np.cumsum(scaled) - scaled  # codes as numbers of the longest length
    out[order] = before >> (longest - sizes[order]).astype(np.uint64)
    return out


def pack(ids: np.ndarray, sizes: np.ndarray, values: np.ndarray, every: int) -> tuple[bytes, bytes]:
    """The bit stream of ids, and the bit offset of each `every`-th of them."""
    if not len(ids):
        return b"", b""
    size = sizes[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    n = int(ends[-1] + 31) // 32 + 1
    word = at >> 5
    bits = values[ids] << (64 - (at & 31) - size).astype(np.uint64)
    # codes never share a bit, so adding them is joining them, exactly in a double
    out = np.bincount(word, (bits >> np.uint64(32)).astype(np.float64), n)
    out += np.bincount(word + 1, (bits & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
    return out.astype(">u4").tobytes(), at[::every].astype("<u8").tobytes()


class Decoder:
    """Reads bit streams by table, all stretches between checkpoints side by side."""

    def __init__(self, sizes: np.ndarray):
        self.width = max(1, int(sizes.max()) if len(sizes) else 1)
        order = np.lexsort((np.arange(len(sizes)), sizes))
        order = order[sizes[order] > 0]
        times = np.left_shift(1, self.width - sizes[order].astype(np.int64))
        table = np.zeros(1 << self.width, np.uint32)
        entries = order.astype(np.uint32) << np.uint32(5) | sizes[order].astype(np.uint32)
        table[: int(times.sum())] = np.repeat(entries, times)
        self.table = table

    def unpack(self, stream: bytes, offsets: bytes, n: int, every: int) -> np.ndarray:
        if not n:
            return np.empty(0, np.uint32)
        words = np.frombuffer(stream, ">u4").astype(np.uint64)
        ahead = np.append(words[1:], np.uint64(0))
        joined = (words << np.uint64(32)) | ahead
        at = np.frombuffer(offsets, "<u8").astype(np.int64)
        out = np.zeros((len(at), every), np.uint32)
        last = n - (len(at) - 1) * every
        shift, mask = 64 - self.width, np.uint64((1 << self.width) - 1)
        for step in range(every):
            if step == last:  # the last stretch is shorter
                at = at[:-1]
            if not len(at):
                break
            window = joined[at >> 5] >> (shift - (at & 31)).astype(np.uint64)
            entry = self.table[window & mask]
            out[: len(at), step] = entry >> np.uint32(5)
            at = at + (entry & np.uint32(31)).astype(np.int64)
        return out.reshape(-1)[:n]
