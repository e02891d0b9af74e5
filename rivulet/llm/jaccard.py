"""Similarity join on word shingles by prefixes of token combinations.

A document's set holds its distinct shingles of SIZE words. Two documents link when
100 * intersection >= PERCENT * union; a class is what links connect.

Candidates. A document that links with one of n shingles misses at most
n - ceil(PERCENT n / 100) of them, so documents that link share a signature out of short
prefixes of their sets. The order is global: rare shingles first, by hash. A rare one is a
signature alone and moves the prefix one miss ahead. Frequent shingles are dealt into
groups; a signature is a pair of them in one group, and a group of x shingles moves the
prefix ahead by x - 1, so prefixes grow until the groups cover the possible misses. The
number of groups depends on the size class of the set; a set also gives signatures for the
next class where a larger partner can be in it. Which shingles are frequent is decided by
a sketch of fixed size over all documents; any decision is right, as long as it is the
same for all, and this one only has to find what would make large groups.

Classes. Equal sets are one document from the start. Links are needed only between
classes: a few rounds verify one pair for each document, against the document with which
it shares most signatures among the leaders of its signature groups, and join classes.
Then every pair of documents that share a signature and are still in different classes is
verified if they share as many as linked documents of their sizes must: prefixes go on a
little beyond the first signature, and a partner of known size leaves fewer misses than any
partner may, both of which ask for more. Each signature knows its place in the prefix, so
pairs meet only in the part of their prefixes that their sizes need. So no link between different classes is missed, and
groups of thousands of near copies cost a few pairs for each copy, not all pairs. Pairs are
verified on the texts.

Defined cases: a null or empty text has an empty set and is a class of its own; fewer
than SIZE words are one shingle. Rows that share a doc_id are one document in links; each
row has its own n_shingles. A null doc_id takes no part and has a null class. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import words as W
from rivulet.llm.scratch import Scratch

SIZE = 5
PERCENT = 80
SKETCH = 1 << 20  # buckets
ROUNDS = 3
EXTRA = 2  # percent of a set by which prefixes go on, so that more must be shared


def sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as hashes."""
    alphabet = W.blank_separated(fold=True)
    split = W.split(texts, alphabet)
    hashes = split.hashes(alphabet)
    grams = W.ngrams(hashes, size, 5)
    out = []
    for low, high in zip(split.first[:-1].tolist(), split.first[1:].tolist(), strict=True):
        if high - low >= size:
            out.append(np.unique(grams[low : high - size + 1]))
        else:
            out.append(W.ngrams(hashes[low:high], high - low, 6) if high > low else hashes[:0])
    return out


def _bucket(shingles: np.ndarray, buckets: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)


def frequent(docs: DataFrame, size: int = SIZE, buckets: int = SKETCH) -> np.ndarray:
    """Which buckets hold more documents than buckets of rare shingles do: a fixed-size mask."""
    width = 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in W.slices(batches):
            found = sets(batch.column("text"), size)
            if found:
                total += np.bincount(_bucket(np.concatenate(found), buckets), minlength=buckets)
        yield from _chunks(total.reshape(-1, width))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                values = np.frombuffer(counts.as_buffer(), "<i8")
                total[chunk] = total[chunk] + values if chunk in total else values
        if total:
            yield from _chunks(np.stack(list(total.values())), list(total))

    summed = (
        docs.select("text")
        .mapInArrow(count, "chunk int, counts binary")
        .repartition("chunk")
        .mapInArrow(add, "chunk int, counts binary")
    )
    out = np.zeros((buckets // width, width), np.int64)
    for row in summed.toLocalIterator():  # the sketch, whatever the input
        out[row["chunk"]] = np.frombuffer(row["counts"], "<i8")
    out = out.reshape(-1)
    middle = np.median(out)
    spread = np.median(np.abs(out - middle)) * 1.4826
    return out > middle + 8 * spread + 32


def _chunks(rows: np.ndarray, names: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    names = list(range(len(rows))) if names is None else names
    some = [(c, r) for c, r in zip(names, rows, strict=True) if r.any()]
    if some:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in some], pa.int32()),
                pa.array([r.astype("<i8").tobytes() for _, r in some], pa.binary()),
            ],
            names=["chunk", "counts"],
        )


def _grades(n: int, percent: int) -> list[int]:
    """Size classes in which a set of n shingles gives signatures: its own and a partner's."""
    return list(range(n.bit_length() - 1, (n * 100 // percent).bit_length()))


def _groups(common: np.ndarray, grade: int) -> np.ndarray:
    return (common & np.uint64(0xFFFFFF)).astype(np.int64) % max(1, (1 << grade) // 10)


def _misses(n: int, percent: int) -> int:
    """Shingles that a set of n can miss of one that it links with; -1: only an equal set."""
    if (n + 1) * percent > n * 100 and n * percent > (n - 1) * 100:
        return -1
    return n - (percent * n + 99) // 100


def least_shared(shingles: np.ndarray, often: np.ndarray, percent: int = PERCENT) -> int:
    """Signatures that a set shares with any that it links with, if that one asks no fewer.

    Prefixes go on EXTRA percent of the set beyond what one shared signature needs, as far
    as the set allows; each step more is a shared signature more.
    """
    n = len(shingles)
    miss = _misses(n, percent)
    if miss < 0:
        return 0
    want = 1 + n * EXTRA // 100
    common = shingles[often]
    rare = n - len(common)
    if rare >= miss + want:
        return want
    moves = [
        rare + len(common) - len(np.unique(_groups(common, grade)))
        for grade in _grades(n, percent)
    ]
    return max(1, min(want, min(moves) - miss))


def signatures(
    shingles: np.ndarray, often: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a sorted set, and how many misses ahead of its start the prefix is with
    each; often says which of its shingles are frequent."""
    n = len(shingles)
    miss = _misses(n, percent)
    if miss < 0:
        return shingles[:0], np.empty(0, np.int32)
    need = miss + 1 + n * EXTRA // 100
    rare = shingles[~often][:need]
    place = np.arange(1, len(rare) + 1, dtype=np.int32)
    if len(rare) == need:
        return rare, place
    out, places = [rare], [place]
    common = shingles[often]
    for grade in _grades(n, percent):
        group = _groups(common, grade)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        first = np.zeros(len(common), bool)
        first[order[starts]] = True  # the first of a group moves nothing ahead
        ahead = len(rare) + np.cumsum(~first)
        enough = int(np.searchsorted(ahead, need)) + 1
        chosen, where = common[:enough], group[:enough]
        order = np.argsort(where, kind="stable")
        chosen, where, reached = chosen[order], where[order], ahead[:enough][order]
        with np.errstate(over="ignore"):
            tag = np.uint64(2 * grade + 1) * np.uint64(0x9E3779B97F4A7C15)
            for step in range(1, len(chosen)):  # pairs at a distance inside a group
                same = where[step:] == where[:-step]
                if not same.any():
                    break
                a, b = chosen[:-step][same], chosen[step:][same]
                out.append(W.mix(a * np.uint64(0xD1342543DE82EF95) + (b ^ tag)))
                places.append(reached[step:][same].astype(np.int32))
    return np.concatenate(out), np.concatenate(places)


_BASE = "doc_id long, n_shingles long, least int, one long, two long"


def _index(mask, size: int, percent: int):
    """A row for each signature; computed anew where it is read, which is less to store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = mask.value
        for batch in W.slices(batches):
            found = sets(batch.column("text"), size)
            marks = [signatures(s, often[_bucket(s, len(often))], percent) for s in found]
            times = np.array([len(m) for m, _ in marks], np.int64)
            flat = np.concatenate([m for m, _ in marks] or [np.empty(0, np.uint64)])
            place = np.concatenate([p for _, p in marks] or [np.empty(0, np.int32)])
            docs = batch.column("doc").take(pa.array(np.repeat(np.arange(len(marks)), times)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), docs, pa.array(place)],
                names=["signature", "doc", "place"],
            )

    return run


def _describe(mask, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = mask.value
        for batch in W.slices(batches):
            found = sets(batch.column("text"), size)
            least = [least_shared(s, often[_bucket(s, len(often))], percent) for s in found]
            one = [int(W.mix(s.copy()).sum(dtype=np.uint64).view(np.int64)) for s in found]
            two = [int(W.mix(~s).sum(dtype=np.uint64).view(np.int64)) for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(least, pa.int32()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                ],
                names=["doc_id", "n_shingles", "least", "one", "two"],
            )

    return run


def _noded(size: int):
    """The texts with what tells them apart, where they share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            marked = batch.column("marked").fill_null(False).to_pylist()
            found = sets(batch.column("text"), size)
            found = [s if m else s[:0] for s, m in zip(found, marked, strict=True)]
            one = [int(W.mix(s.copy()).sum(dtype=np.uint64).view(np.int64)) for s in found]
            two = [int(W.mix(~s).sum(dtype=np.uint64).view(np.int64)) for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text").cast(pa.string()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array([len(s) for s in found], pa.int64()),
                    batch.column("marked"),
                ],
                names=["doc", "text", "one", "two", "n_shingles", "marked"],
            )

    return run


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                left, right = (sets(part.column(c), size) for c in ("left", "right"))
                keep = []
                for a, b in zip(left, right, strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(_verify(size, percent), "a long, b long")


def components(edges: DataFrame, out: Scratch) -> DataFrame:
    """node, label: the smallest node that the edges (a, b) connect each node with.

    Each round takes the smallest label among a node and its neighbours, then the label of
    that label; labels only fall, and rounds end when none does. Rounds are written.
    """
    both = out.write(
        edges.where("a <> b").unionAll(edges.where("a <> b").select("b", "a")).distinct(), "edges"
    )
    labels = out.write(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select("a", "label")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        next_ = labels.join(least, "node").select(
            "node", "label", F.least("label", "near").alias("new")
        )
        up = labels.select(F.col("node").alias("new"), F.col("label").alias("up"))
        next_ = next_.join(up, "new", "left").select(
            "node", "label", F.least("new", F.coalesce("up", "new")).alias("new")
        )
        next_ = out.write(next_, "labels")
        labels = next_.select("node", F.col("new").alias("label"))
        if next_.where("new <> label").isEmpty():
            return labels


def _relabelled(labels: DataFrame, links: DataFrame, turn: Scratch, out: Scratch) -> DataFrame:
    """Labels (doc, class) after the links (a, b) between documents."""
    a = labels.select(F.col("doc").alias("a"), F.col("class").alias("ca"))
    b = labels.select(F.col("doc").alias("b"), F.col("class").alias("cb"))
    edges = links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(edges, turn).select(F.col("node").alias("class"), F.col("label").alias("to"))
    return out.write(
        labels.join(joined, "class", "left").select(
            "doc", F.coalesce("to", "class").alias("class")
        ),
        "classes",
    )


def _open(posting: DataFrame, labels: DataFrame, out: Scratch) -> DataFrame:
    """Postings (signature, doc, n, class) of signatures that still hold several classes."""
    now = posting.join(labels, "doc")
    several = out.write(
        now.groupBy("signature")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("signature"),
        "open",
    )
    return out.write(now.join(several, "signature", "left_semi"), "postings")


def _fit(n, m, percent: int):
    """Sizes of sets that can link."""
    return (n * 100 >= m * percent) & (m * 100 >= n * percent)


def _both(n, m, percent: int):
    """Shingles that linked sets of n and m share at least."""
    return F.floor(((n + m) * percent + 99 + percent) / (100 + percent))


def _reach(n, m, percent: int):
    """How far the prefix of a set of n goes that serves partners of m shingles."""
    return n - _both(n, m, percent) + 1 + F.floor(n * EXTRA / 100)


def _asked(n, m, least, other_least, percent: int):
    """Signatures that sets of n and m shingles share if they link.

    Of its own size alone a set knows only how many shingles any partner leaves it; both
    sizes say how many this one must, and each more is a shared signature more.
    """
    both = _both(n, m, percent)
    return F.least(
        least + both - F.floor((n * percent + 99) / 100),
        other_least + both - F.floor((m * percent + 99) / 100),
    )


def classes(
    docs: DataFrame,
    size: int = SIZE,
    percent: int = PERCENT,
    buckets: int = SKETCH,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    if percent < 50:
        raise ValueError("groups of frequent shingles cover similarities of 50 percent or more")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mask = spark.sparkContext.broadcast(frequent(docs, size, buckets))
    kept, turn = Scratch(), Scratch()  # tables of the whole run, and of one round
    base = kept.write(docs.mapInArrow(_describe(mask, size, percent), _BASE), "sets")
    content = ["n_shingles", "one", "two"]
    whole = base.where("doc_id is not null and n_shingles > 0")
    equal = kept.write(
        whole.groupBy(*content).agg(F.min("doc_id").alias("doc"), F.min("least").alias("least")),
        "equal",
    )
    named = docs.where("doc_id is not null").withColumnRenamed("doc_id", "doc")
    # a node is a text by its first id; texts that share that id get nodes of their own
    several = kept.write(
        whole.select("doc_id", *content).distinct().groupBy("doc_id").count().where("count > 1")
        .select(F.col("doc_id").alias("doc")),
        "several",
    )
    clash = not several.isEmpty()
    if clash:
        shared_id = F.col("marked").isNotNull()
        marked = several.withColumn("marked", F.lit(True))
        own = F.xxhash64("doc", *content)
        equal = kept.write(
            equal.join(marked, "doc", "left")
            .withColumn("node", F.when(shared_id, own).otherwise(F.col("doc")))
            .drop("marked"),
            "equal",
        )
        first = equal.select("doc", "node", *content)
        equal = equal.drop("doc").withColumnRenamed("node", "doc")
        named = kept.write(
            named.join(marked, "doc", "left").mapInArrow(_noded(size), "doc long, text string, one long, two long, n_shingles long, marked boolean")
            .withColumn("doc", F.when(shared_id, own).otherwise(F.col("doc")))
            .select("doc", "text"),
            "named",
        )
    index = named.mapInArrow(_index(mask, size, percent), "signature long, doc long, place int")
    keys = turn.write(
        index.groupBy("signature").agg(F.count("*").alias("times")).where("times > 1").select("signature"),
        "signatures",
    )
    sizes = equal.groupBy("doc").agg(F.max("n_shingles").alias("n"), F.min("least").alias("least"))
    shared = turn.write(
        index.join(keys, "signature", "left_semi").join(sizes, "doc").distinct(), "shared"
    )
    keys = turn.write(
        shared.groupBy("signature").agg(F.count("*").alias("times")).where("times > 1").select("signature"),
        "several",
    )
    shared = turn.write(shared.join(keys, "signature", "left_semi"), "shared")
    # a partner has at least `percent` of the shingles and asks for as much less
    fewest = F.lit(1) + F.floor(F.floor(F.col("n") * percent / 100) * EXTRA / 100)
    enough = turn.write(
        shared.groupBy("doc", "n", "least")
        .agg(F.count("*").alias("times"))
        .where(F.col("times") >= F.least("least", fewest))
        .select("doc"),
        "enough",
    )
    posting = kept.write(shared.join(enough, "doc", "left_semi"), "postings")
    texts = kept.write(
        named.join(enough, "doc", "left_semi").dropDuplicates(["doc"]),
        "texts",
    )
    turn.discard()
    # rows of one doc_id with other texts link through it, whatever their sets say
    labels = equal.select("doc", F.col("doc").alias("class")).distinct()
    labels = kept.write(labels, "classes")
    if clash:
        # the texts of one id are one document
        texts_of = whole.join(several, F.col("doc_id") == F.col("doc"), "left_semi").select(
            "doc_id", *content
        )
        nodes = texts_of.join(first, content).select("doc_id", "node").distinct()
        least = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = turn.write(
            nodes.join(least, "doc_id").select("a", F.col("node").alias("b")), "links"
        )
        labels = _relabelled(labels, links, turn, kept)
    for count in range(rounds):
        now = _open(posting, labels, turn)
        order = F.xxhash64(F.lit(count), "doc") if count else F.col("doc")
        leaders = turn.write(
            now.groupBy("signature").agg(
                F.min(F.struct(order.alias("order"), "doc", "n", "class", "least")).alias("leader")
            ),
            "leaders",
        ).select(
            "signature",
            F.col("leader.doc").alias("a"),
            F.col("leader.n").alias("m"),
            F.col("leader.class").alias("other"),
            F.col("leader.least").alias("leader_least"),
        )
        pairs = (
            now.join(leaders, "signature")
            .withColumn(
                "asked",
                _asked(F.col("n"), F.col("m"), F.col("least"), F.col("leader_least"), percent),
            )
            .where((F.col("class") != F.col("other")) & _fit(F.col("n"), F.col("m"), percent))
            .groupBy(F.col("doc").alias("b"), "a")
            .agg(F.count("*").alias("shared"), F.max("asked").alias("asked"))
            .where("shared >= asked")
            .groupBy("b")
            .agg(F.max(F.struct("shared", F.col("a").alias("a"))).alias("best"))
            .select(F.col("best.a").alias("a"), "b")
        )
        links = turn.write(verified(pairs, texts, size, percent), "links")
        done = links.isEmpty()
        if not done:
            labels = _relabelled(labels, links, turn, kept)
        turn.discard()
        if done:
            break
    # everything that shares a signature and is still apart: classes first, so that members
    # of one class never meet each other; the smaller set of a pair (n) needs only the
    # prefix that serves partners of its size or more
    now = _open(posting, labels, turn)
    n, m = F.col("n"), F.col("m")
    short = now.where(F.col("place") <= _reach(n, n, percent)).withColumnRenamed("doc", "a")
    long = now.select(
        "signature",
        F.col("class").alias("other"),
        F.col("doc").alias("b"),
        F.col("n").alias("m"),
        F.col("least").alias("other_least"),
        F.col("place").alias("other_place"),
    )
    serves = (
        _fit(n, m, percent)
        & (n <= m)
        & (F.col("place") <= _reach(n, m, percent))
        & (F.col("other_place") <= _reach(m, n, percent))
    )
    mine = short.groupBy("signature", "class", "n").agg(F.min("place").alias("place"))
    theirs = long.groupBy("signature", "other", "m").agg(F.min("other_place").alias("other_place"))
    apart = (
        mine.join(theirs, "signature")
        .where((F.col("class") != F.col("other")) & serves)
        .select("signature", "class", "n", "other", "m")
    )
    extra = F.least(F.floor(n * EXTRA / 100), F.floor(m * EXTRA / 100)) + 1
    pairs = (
        apart.join(short, ["signature", "class", "n"])
        .join(long, ["signature", "other", "m"])
        .where(serves & ((n < m) | (F.col("a") < F.col("b"))))
        .groupBy("a", "b")
        .agg(
            F.count("*").alias("shared"),
            F.max(
                F.least(extra, _asked(n, m, F.col("least"), F.col("other_least"), percent))
            ).alias("asked"),
        )
        .where("shared >= asked")
        .select("a", "b")
    )
    links = turn.write(verified(pairs, texts, size, percent), "links")
    if not links.isEmpty():
        labels = _relabelled(labels, links, turn, kept)
    turn.discard()
    if clash:
        ids = whole.join(equal, content).join(labels, "doc").select("class", "doc_id")
        low = ids.groupBy("class").agg(F.min("doc_id").alias("low"))
        labels = labels.join(low, "class").select("doc", F.col("low").alias("class"))
    final = equal.join(labels, "doc").select(*content, "class")
    rows = base.select("doc_id", *content)
    out = rows.join(final, content, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("class")).alias("component_id"),
    )
    return out.withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    )


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents of each class but its first by doc_id; all their columns.

    Rows without a doc_id stay; of rows that share the first doc_id all stay.
    """
    found = classes(docs, size, percent)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
