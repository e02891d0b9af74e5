"""Phrase collocations, counted in direct-address tiles.

Words are ranked by frequency; the most frequent have their rank as id. A pair of ranked
words is a cell of a square matrix that is cut into tiles. A tile that meets many pairs is
counted densely (numpy's bincount over its cells); pairs of thinly filled tiles, and pairs
with a word beyond the ranks, go to a sorted list of coordinates with counts. Pairs that
are frequent enough are ranked in turn and stand for one unit, so that counting pairs of
neighbouring units gives phrases of three words, and once more, of four.

Each level is one pass over whole texts. What the passes share has a fixed size: the
ranked units (`HEAD`) and a bit set of all units frequent enough (`BITS`, one bit for a
hash). The bit set lets a pass leave out most pairs that can't be frequent; a false hit
costs time, never a count, since counts are kept by the words' ids. Ids are 64-bit hashes
of language and word. Whether any two words share one is checked over the whole
vocabulary, and if a frequent word is concerned, everything is counted with another seed.

Words and phrases live within a language and a piece of text between separators, A-Z in
lower case. Defined cases: a null lang is `und`, a null text has no words; repeated rows
and ids count each time; empty texts and an empty table give no rows; a text of any
length is worked on in bounded slices; columns other than `text` and `lang` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm import words
from rivulet.llm.scratch import Scratch

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a candidate
COVER = 80  # per cent of a candidate inside a longer one that drop it
TOP = 2000  # candidates returned for each language
SCALE = 1_000_000

HEAD = 8_192  # units with a rank
TILE = 512  # ranks to a side of a tile
DENSE = 8  # tiles a task counts densely at a time
FILLED = TILE * TILE // 16  # pairs in one slice that make a tile dense
PENDING = 400_000  # different coordinates a task holds before it hands them on
BITS = 25
SLICE_BYTES = 1 << 19  # of text, worked on at a time
SALTS = 16
GATHER = 4  # splits of text that one task counts phrases of three words and more over

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _alphabet() -> words.Alphabet:
    """[^\\x20\\x09.,;:!?\\x0A-\\x0D]+ with A-Z lower-cased."""
    inside = np.ones(256, bool)
    inside[[32, 9, *_SEPARATORS]] = False
    return words.Alphabet.of(inside, fold=True)


def _lang_value(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


class Slice:
    """The words of a slice of documents: their ids, and whether the next one follows on."""

    def __init__(self, batch: pa.RecordBatch, alphabet: words.Alphabet, seed: int):
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.found = found = words.split(batch.column("text"), alphabet)
        salts = np.array([_lang_value(x, seed) for x in self.langs], np.uint64)
        self.lang = np.repeat(self.code, found.counts)  # of each word
        ids = found.hashes(alphabet, seed)
        if len(ids):
            ids ^= salts[self.lang]
        self.ids = words.mix(ids)
        # a word follows on if it is of the same document, with no separator between
        breaks = np.concatenate(([0], np.cumsum(np.isin(found.buffer, list(_SEPARATORS)))))
        gap = breaks[found.start[1:]] - breaks[found.end[:-1]]
        document = found.document()
        self.follows = np.zeros(len(self.ids), bool)
        if len(self.ids):
            self.follows[:-1] = (gap == 0) & (document[1:] == document[:-1])


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Slice]:
    alphabet = _alphabet()
    for batch in words.slices(batches, most=SLICE_BYTES):
        yield Slice(batch, alphabet, seed)


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, seed):
            if not len(part.ids):
                continue
            ids, first, counts = np.unique(part.ids, return_index=True, return_counts=True)
            found = part.found
            folded = _FOLD[found.buffer].tobytes()
            spelled = [
                folded[low:high]
                for low, high in zip(found.start[first].tolist(), found.end[first].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.langs[x] for x in part.lang[first].tolist()], pa.string()),
                    pa.array(ids.view(np.int64)),
                    pa.array(spelled, pa.binary()).cast(pa.string()),
                    pa.array(counts),
                ],
                names=["lang", "id", "word", "n"],
            )

    return run


def _vocabulary(texts: DataFrame, scratch: Scratch, least: int) -> tuple[DataFrame, int]:
    """lang, id, word, n of every word, and the seed of ids that tell frequent words apart."""
    seed = 0
    while True:
        rows = texts.mapInArrow(_count_words(seed), "lang string, id long, word string, n long")
        counted = rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
        counted = scratch.write(counted, "phrases-words")
        shared = counted.groupBy("id").agg(F.count("*").alias("words"), F.sum("n").alias("n"))
        if shared.where((F.col("words") > 1) & (F.col("n") >= least)).isEmpty():
            return counted, seed
        seed += 1


# --- units: what a pass knows of the level below -------------------------------


class Units:
    """Units of `size` words: the ranked ones, and the bits of all frequent enough."""

    def __init__(self, head: np.ndarray, hashes: np.ndarray, bits: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.rank = hashes[order], order
        self.head, self.bits = head, bits  # head[rank] holds the ids of the unit's words

    def ranks(self, hashes: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
        """The rank of each unit; -1 where it has none."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes) or not len(hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        rank = self.rank[at[hit]]
        same = np.ones(len(hit), bool)
        for column, own in enumerate(ids):
            same &= self.head[rank, column] == own[hit]
        out[hit[same]] = rank[same]
        return out

    def may_be_frequent(self, hashes: np.ndarray) -> np.ndarray:
        word = (hashes >> np.uint64(6)) & np.uint64(len(self.bits) - 1)
        return (self.bits[word] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def _units(frequent: DataFrame, size: int, head: int, bits: int) -> Units:
    """Both parts have a fixed size, whatever the number of frequent units.

    `frequent` has w1 to w`size`, their `hash` and the count n.
    """
    ids = [f"w{i + 1}" for i in range(size)]
    top = frequent.orderBy(F.desc("n"), *ids).limit(head).select(*ids, "hash").toArrow()
    columns = [top.column(c).to_numpy().view(np.uint64) for c in ids]
    mask = (1 << (bits - 6)) - 1
    place = F.shiftrightunsigned("hash", 6).bitwiseAND(F.lit(mask))
    bit = F.expr("shiftleft(1L, cast(hash & 63 as int))")
    found = frequent.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(mask + 1, np.uint64)
    table[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    matrix = np.stack(columns, 1) if len(top) else np.empty((0, size), np.uint64)
    return Units(matrix, top.column("hash").to_numpy().view(np.uint64), table)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring units."""
    return words.mix(
        words.mix(left.copy()) * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(1)
    )


# --- counting pairs ----------------------------------------------------------


class Tiles:
    """Counts of pairs of ranks in dense tiles, of all other pairs as sorted coordinates."""

    def __init__(
        self, units: Units, size: int, tile: int = TILE, dense: int = DENSE, filled: int = FILLED
    ):
        self.units, self.size = units, size
        self.tile, self.most, self.filled = tile, dense, filled
        self.side = -(-max(len(units.head), 1) // tile)
        self.dense: dict[int, np.ndarray] = {}
        self.loose: list[tuple[np.ndarray, list[np.ndarray], np.ndarray]] = []
        self.pending = self.left = 0  # coordinates, and those the last summing up has left

    def add(self, left: np.ndarray, right: np.ndarray, ids: list[np.ndarray]) -> None:
        """Pairs by rank (-1 for none) and by the ids of all their words."""
        ranked = (left >= 0) & (right >= 0)
        a, b = left[ranked], right[ranked]
        side = self.tile
        tile = (a // side) * self.side + b // side
        order = np.argsort(tile.astype(np.uint16 if self.side < 256 else np.int64), kind="stable")
        edges = np.flatnonzero(np.diff(tile[order], prepend=-1, append=-1))
        sparse = [np.flatnonzero(~ranked)]
        where = np.flatnonzero(ranked)
        for low, high in zip(edges[:-1], edges[1:]):
            own = order[low:high]
            key = int(tile[own[0]])
            if key not in self.dense:
                if high - low < self.filled or len(self.dense) == self.most:
                    sparse.append(where[own])
                    continue
                self.dense[key] = np.zeros(side * side, np.int64)
            cell = (a[own] % side) * side + b[own] % side
            self.dense[key] += np.bincount(cell, minlength=side * side)
        rest = np.concatenate(sparse)
        if len(rest):
            columns = [c[rest] for c in ids]
            self.loose.append(_summed(columns, np.ones(len(rest), np.int64)))
            self.pending += len(self.loose[-1][2])

    def compress(self) -> None:
        if len(self.loose) > 1:
            columns = [np.concatenate(c) for c in zip(*(x[1] for x in self.loose))]
            self.loose = [_summed(columns, np.concatenate([x[2] for x in self.loose]))]
        self.pending = self.left = sum(len(x[2]) for x in self.loose)

    def sparse_rows(self) -> Iterator[pa.RecordBatch]:
        self.compress()
        for hashes, columns, counts in self.loose:
            yield from _batches(hashes, columns, counts)
        self.loose, self.pending, self.left = [], 0, 0

    def dense_rows(self) -> Iterator[pa.RecordBatch]:
        for key, counts in self.dense.items():
            cell = np.flatnonzero(counts)
            left = (key // self.side) * self.tile + cell // self.tile
            right = (key % self.side) * self.tile + cell % self.tile
            head = self.units.head
            columns = [head[left, i] for i in range(self.size)] + [head[right, self.size - 1]]
            yield from _batches(_hash(columns), columns, counts[cell])


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """The hash of units given by the ids of their words; that of one word is its id."""
    level = columns
    while len(level) > 1:
        level = [_join(a, b) for a, b in zip(level, level[1:])]
    return level[0]


def _summed(columns: list[np.ndarray], counts: np.ndarray):
    """Coordinates in the order of their hash, those with the same words as one."""
    hashes = _hash(columns)
    order = np.argsort(hashes, kind="stable")
    hashes, columns = hashes[order], [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    return hashes[first], [c[first] for c in columns], np.add.reduceat(counts[order], first)


def _batches(hashes, columns, counts, most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    names = ["hash", *[f"w{i + 1}" for i in range(len(columns))], "n"]
    for low in range(0, len(counts), most):
        cut = slice(low, low + most)
        arrays = [hashes[cut].view(np.int64), *[c[cut].view(np.int64) for c in columns], counts[cut]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)


def _count_pairs(levels, seed: int):
    """Phrases one word longer than the units of the last level, which all levels lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: list[Units] = [level.value for level in levels]
        size = len(units)
        tiles = Tiles(units[-1], size)
        for part in _slices(batches, seed):
            hashes = part.ids
            sound = units[0].may_be_frequent(hashes)
            link = part.follows
            for below in units[1:]:
                # a unit at each word: this one and the next, joined
                both = sound[:-1] & sound[1:] & link[:-1]
                hashes = _join(hashes[:-1], hashes[1:])
                sound = both & below.may_be_frequent(hashes)
                link = np.ones(len(hashes), bool)  # overlapping units are in one piece
            at = np.flatnonzero(sound[:-1] & sound[1:] & link[:-1])
            if not len(at):
                continue
            ids = [part.ids[at + i] for i in range(size + 1)]
            left = units[-1].ranks(hashes[at], ids[:size])
            right = units[-1].ranks(hashes[at + 1], ids[1:])
            tiles.add(left, right, ids)
            # summed up whenever as many have come as were left the last time
            if tiles.pending > max(2 * tiles.left, PENDING // 2):
                tiles.compress()
                if tiles.pending > PENDING:
                    yield from tiles.sparse_rows()
        yield from tiles.sparse_rows()
        yield from tiles.dense_rows()

    return run


def _gathered(texts: DataFrame) -> DataFrame:
    """Fewer and larger partitions, but two for each core at least; nothing is shuffled."""
    places = texts.select(F.spark_partition_id().alias("place"))  # reads no text
    last = places.agg(F.max("place")).first()[0] or 0
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.coalesce(max(2 * cores, -(-(last + 1) // GATHER)))


def _frequent_phrases(
    texts: DataFrame, vocabulary: DataFrame, seed: int, scratch: Scratch, least: int, longest: int
) -> list[DataFrame]:
    """hash, w1, w2, …, n of all phrases of two words, of three, and so on."""
    context = texts.sparkSession.sparkContext
    units = vocabulary.where(F.col("n") >= least).select(
        F.col("id").alias("hash"), F.col("id").alias("w1"), "n"
    )
    levels, found = [], []
    gathered = _gathered(texts)
    for size in range(1, longest):
        levels.append(context.broadcast(_units(units, size, HEAD, BITS)))  # of fixed size
        ids = [f"w{i + 1}" for i in range(size + 1)]
        schema = ", ".join(f"{name} long" for name in ["hash", *ids, "n"])
        part = texts if size < 2 else gathered
        rows = part.mapInArrow(_count_pairs(list(levels), seed), schema)
        counted = rows.groupBy("hash", *ids).agg(F.sum("n").alias("n"))
        units = scratch.write(counted.where(F.col("n") >= least), f"phrases-{size + 1}")
        found.append(units)
    return found


# --- scores ------------------------------------------------------------------


def _salted(rows: DataFrame, part: str, whole: str) -> DataFrame:
    """Parts of one word are in many candidates: they are dealt to several keys."""
    salt = F.when(F.size(part) == 1, F.pmod(F.xxhash64(whole), F.lit(SALTS))).otherwise(F.lit(0))
    return rows.withColumn("salt", salt)


def _parts(vocabulary: DataFrame, phrases: list[DataFrame], least: int) -> DataFrame:
    """key, f, lang of everything a candidate can be cut into; words once for each salt."""
    single = vocabulary.where(F.col("n") >= least).select(
        F.array("id").alias("key"),
        F.col("n").alias("f"),
        "lang",
        F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"),
    )
    for rows in phrases[:-1]:
        several = rows.select(
            _words(rows).alias("key"),
            F.col("n").alias("f"),
            F.lit(None).cast("string").alias("lang"),
            F.lit(0).cast("long").alias("salt"),
        )
        single = single.unionAll(several)
    return single


def _words(rows: DataFrame):
    return F.array(*[c for c in rows.columns if c.startswith("w")])


def _scored(candidates: DataFrame, parts: DataFrame, cover: int) -> DataFrame:
    """lang, ws, a, l, r, score of the candidates that no longer one covers."""
    cuts = candidates.select(
        "ws", "a", F.explode(F.expr("sequence(1, size(ws) - 1)")).alias("k")
    ).select(
        "ws",
        "a",
        "k",
        F.expr("slice(ws, 1, k)").alias("first"),
        F.expr("slice(ws, k + 1, size(ws) - k)").alias("rest"),
    )
    left = parts.select(F.col("key").alias("first"), F.col("f").alias("l"), "lang", "salt")
    right = parts.select(F.col("key").alias("rest"), F.col("f").alias("r"), "salt")
    cuts = _salted(cuts, "first", "ws").join(left, ["first", "salt"]).drop("salt")
    cuts = _salted(cuts, "rest", "ws").join(right, ["rest", "salt"])
    # an exact quotient of decimals, rounded down
    score = F.expr(f"(cast({2 * SCALE} as decimal(8, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0))")
    cut = F.struct(score.alias("score"), "k", "l", "r")
    inner = (
        candidates.where(F.size("ws") > 2)
        .select(
            F.col("a").alias("cover"),
            F.explode(
                F.expr(
                    "flatten(transform(sequence(2, size(ws) - 1), m -> transform("
                    "sequence(1, size(ws) - m + 1), i -> slice(ws, i, m))))"
                )
            ).alias("ws"),
        )
        .groupBy("ws")
        .agg(F.max("cover").alias("cover"))
    )
    none = F.lit(None)
    rows = cuts.select("ws", "a", "lang", cut.alias("cut"), none.cast("long").alias("cover"))
    kind = rows.schema["cut"].dataType
    rows = rows.unionAll(
        inner.select(
            "ws",
            none.cast("long").alias("a"),
            none.cast("string").alias("lang"),
            none.cast(kind).alias("cut"),
            "cover",
        )
    )
    best = rows.groupBy("ws").agg(
        F.max("a").alias("a"),
        F.max("lang").alias("lang"),
        F.min("cut").alias("cut"),
        F.max("cover").alias("cover"),
    )
    covered = 100 * F.col("cover") >= cover * F.col("a")
    kept = best.where(F.col("a").isNotNull() & ~F.coalesce(covered, F.lit(False)))
    return kept.select("lang", "ws", "a", "cut.l", "cut.r", "cut.score")


def mine(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    cover: int = COVER,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    a is the phrase's count, l and r those of the two parts of its lowest-scoring cut, n
    all words of the language; the score is floor(2000000 * a / (l + r)).
    """
    scratch = Scratch()
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    vocabulary, seed = _vocabulary(texts, scratch, least)
    phrases = _frequent_phrases(texts, vocabulary, seed, scratch, least, longest)
    candidates = None
    for rows in phrases:
        part = rows.select(_words(rows).alias("ws"), F.col("n").alias("a"))
        candidates = part if candidates is None else candidates.unionAll(part)
    scored = _scored(candidates, _parts(vocabulary, phrases, least), cover)
    # rank() keeps ties beyond the last place, which the phrases decide below; first within
    # parts of a language, so that no task meets more than those leave
    ranked = scored.withColumn("part", F.pmod(F.xxhash64("ws"), F.lit(4 * SALTS)))
    for keys in (["lang", "part"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a")))
        ranked = ranked.withColumn("rank", place).where(F.col("rank") <= top)
    spelled = (
        ranked.select("*", F.posexplode("ws").alias("pos", "id"))
        .join(vocabulary.select("id", "word"), "id")
        .groupBy("lang", "ws", "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
        .withColumn("phrase", F.array_join(F.transform("words", lambda x: x["word"]), " "))
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = spelled.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    total = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    return placed.join(total, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        "l",
        "r",
        "n",
        "score",
    )
