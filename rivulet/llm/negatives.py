"""Hard negatives by a best-first search of STR-packed R-trees.

Rows are dealt into blocks of bounded size. In a task, the rows of a block are packed into
one R-tree for each label by sort-tile-recursion: sorted and cut along the coordinates of
most variance in turn, the tiles become leaves, and consecutive nodes become the parents.
A node's minimum bounding box gives an interval of inner products with an anchor, coordinate
by coordinate. A queue takes the node of the highest possible score first; a box is dropped
if its interval misses every window of scores still open, or ends strictly below the worst
row that would be replaced.

Positives come first: the best rows of the anchor's own label. Each positive's score opens
a window for rows of other labels; one traversal serves all windows of an anchor. Blocks
answer for themselves and their answers are merged by ranking.

Anchors reach the blocks through the shuffle that deals the rows, sorted behind them, so a
task holds one block and streams through the anchors, however many; nothing passes the
driver but the number of rows.

Defined cases: rows with a null vec_id, label or vector, an empty vector, or null or
non-finite components take no part. Rows that are the same in vec_id, label and vector count
once; an anchor's own vec_id is never among its positives or negatives. Anchors that share a
vec_id but not label and vector are anchors each. Vectors of different lengths do not meet.
Ties go to the smaller vec_id. A positive without a row in its window gives no rows, as does
an empty table; other columns are not read. Scores are exact while they, and the bounds,
stay below 2^53.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.scratch import Scratch

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW = 80  # per cent of the positive's score that a negative has at least
BLOCK = 65_536  # rows of a block, on average
LEAF = 256
FANOUT = 8


def participants(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and the whole numbers floor(scale * x) of the rows that take part."""
    finite = F.forall(
        "embedding", lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return rows.where(sound & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole.alias("v"),
    )


# --- the tree ----------------------------------------------------------------


def _tiles(rows: np.ndarray, axes: list[int], leaf: int) -> list[np.ndarray]:
    """Sort-tile-recursion: the rows of each leaf, leaves in the order of the tiles."""
    parts = [np.arange(len(rows))]
    for left, axis in zip(range(len(axes), 0, -1), axes):
        cut = []
        for part in parts:
            leaves = -(-len(part) // leaf)
            slabs = int(np.ceil(leaves ** (1 / left) - 1e-9))
            order = part[np.argsort(rows[part, axis], kind="stable")]
            cut += [x for x in np.array_split(order, slabs) if len(x)]
        parts = cut
    return parts


class Forest:
    """One R-tree for each label over rows of one length.

    Nodes 0 to len(first)-1 are leaves over rows first[i] to last[i], the others lie over
    nodes first[i] to last[i].
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, leaf: int, fanout: int):
        self.roots: dict[int, int] = {}
        order, leaves, owners = [], [], []
        for label in np.unique(labels):
            own = np.flatnonzero(labels == label)
            axes = np.argsort(-rows[own].var(0), kind="stable")
            depth = max(1, int(np.log2(max(1, -(-len(own) // leaf)))))
            tiles = _tiles(rows[own], axes[:depth].tolist(), leaf)
            order += [own[t] for t in tiles]
            leaves += [len(t) for t in tiles]
            owners += [int(label)] * len(tiles)
        chosen = np.concatenate(order)
        self.ids, self.rows = ids[chosen], rows[chosen]
        last = np.cumsum(leaves)
        self.first, self.last = (last - leaves).tolist(), last.tolist()
        self.leaves = len(leaves)
        low = [np.minimum.reduceat(self.rows, self.first)]
        high = [np.maximum.reduceat(self.rows, self.first)]
        level = list(range(self.leaves))
        while level:
            parents, edges, following = [], [], []
            at = 0
            while at < len(level):
                to = at + 1
                while to < min(at + fanout, len(level)) and owners[level[to]] == owners[level[at]]:
                    to += 1
                label = owners[level[at]]
                alone = to - at == 1 and (at == 0 or owners[level[at - 1]] != label)
                if alone and (to == len(level) or owners[level[to]] != label):
                    self.roots[label] = level[at]  # the only node of its label
                else:
                    edges.append(at)
                    parents.append((level[at], level[to - 1] + 1, label))
                at = to
            if parents:
                below_low, below_high = np.concatenate(low), np.concatenate(high)
                for first, end, label in parents:
                    following.append(len(self.first))
                    self.first.append(first)
                    self.last.append(end)
                    owners.append(label)
                low.append(np.array([below_low[a:b].min(0) for a, b, _ in parents]))
                high.append(np.array([below_high[a:b].max(0) for a, b, _ in parents]))
            level = following
        self.low, self.high = np.concatenate(low), np.concatenate(high)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return (
            up @ self.low.T + down @ self.high.T,
            up @ self.high.T + down @ self.low.T,
        )


class Range:
    """The best rows with scores from `least` to `most`."""

    def __init__(self, least: float, most: float, k: int):
        self.need, self.most, self.k = least, most, k
        self.scores, self.ids = np.empty(0), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.need) & (scores <= self.most))
        if not len(fit):
            return
        scores = np.concatenate([self.scores, scores[fit]])
        ids = np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.need = scores[order[-1]]  # what ties with it may still win by its id


def best_first(
    forest: Forest,
    roots: list[int],
    anchor: np.ndarray,
    own: int,
    least: list[float],
    most: list[float],
    windows: list[Range],
) -> None:
    """Fills the windows; `least` and `most` are the anchor's intervals by node."""
    highest = max(w.most for w in windows)

    def wanted(node: int) -> bool:
        return any(most[node] >= w.need and least[node] <= w.most for w in windows)

    queue = [(-min(most[r], highest), r) for r in roots if wanted(r)]
    heapq.heapify(queue)
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < min(w.need for w in windows):
            return
        if not wanted(node):
            continue
        first, last = forest.first[node], forest.last[node]
        if node < forest.leaves:
            scores = forest.rows[first:last] @ anchor
            hit = np.flatnonzero(scores >= min(w.need for w in windows))
            hit = hit[forest.ids[first:last][hit] != own]
            if len(hit):
                ids, scores = forest.ids[first:last][hit], scores[hit]
                for window in windows:
                    window.add(scores, ids)
        else:
            for child in range(first, last):
                if wanted(child):
                    heapq.heappush(queue, (-min(most[child], highest), child))


# --- blocks and anchors ------------------------------------------------------


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and rows of a batch, by length of vector."""
    lists = batch.column("v")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[(ends[rows] - size)[:, None] + np.arange(size)]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Cuts a batch where the block changes, or where its rows end and its anchors begin."""
    block = batch.column("block").to_numpy()
    is_anchor = batch.column("is_anchor").to_numpy(zero_copy_only=False).astype(bool)
    change = np.flatnonzero((np.diff(block) != 0) | (is_anchor[1:] != is_anchor[:-1])) + 1
    edges = [0, *change.tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield int(block[low]), bool(is_anchor[low]), batch.slice(low, high - low)


def _forests(rows: list[pa.RecordBatch], leaf: int, fanout: int) -> dict[int, Forest]:
    gathered: dict[int, list] = {}
    for batch in rows:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for at, matrix in _matrices(batch):
            gathered.setdefault(matrix.shape[1], []).append((ids[at], labels[at], matrix))
    return {
        size: Forest(*[np.concatenate(x) for x in zip(*parts)], leaf, fanout)
        for size, parts in gathered.items()
    }


def _search(answer, names: list[str], leaf: int, fanout: int):
    """Builds each block's trees from its rows and asks `answer` about each of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, forests = None, [], None
        for batch in batches:
            for block, is_anchor, part in _runs(batch):
                if block != current:
                    current, rows, forests = block, [], None
                if not is_anchor:
                    rows.append(part)
                    continue
                if forests is None:
                    forests, rows = _forests(rows, leaf, fanout), []
                found: list[tuple] = []
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                prints = part.column("print").to_numpy()
                limits = part.column("limits").to_pylist()
                for at, matrix in _matrices(part):
                    forest = forests.get(matrix.shape[1])
                    if forest is None:
                        continue
                    least, most = forest.intervals(matrix)
                    for i, place in enumerate(at.tolist()):
                        found += answer(
                            forest, int(ids[place]), int(labels[place]), int(prints[place]),
                            matrix[i], least[i].tolist(), most[i].tolist(), limits[place],
                        )
                if found:
                    arrays = [pa.array(x, pa.int64()) for x in zip(*found)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _positives(k: int):
    def answer(forest, own, label, mark, anchor, least, most, limits):
        root = forest.roots.get(label)
        if root is None:
            return []
        window = Range(-np.inf, np.inf, k)
        best_first(forest, [root], anchor, own, least, most, [window])
        return [(own, mark, int(i), int(s)) for i, s in zip(window.ids, window.scores)]

    return answer


def _negatives(k: int, low: int):
    def answer(forest, own, label, mark, anchor, least, most, limits):
        roots = [root for other, root in forest.roots.items() if other != label]
        windows = {}
        for positive in limits:
            score = positive["score"]
            if low * score <= 100 * score:  # else no score is in the window
                windows[score] = Range(float(-(-low * score // 100)), float(score), k)
        if not roots or not windows:
            return []
        best_first(forest, roots, anchor, own, least, most, list(windows.values()))
        return [
            (own, mark, positive["vec_id"], positive["score"], int(i), int(s))
            for positive in limits
            if (window := windows.get(positive["score"])) is not None
            for i, s in zip(window.ids, window.scores)
        ]

    return answer


def _dealt(rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Every row in its block, and behind a block's rows every anchor."""
    limits = "array<struct<vec_id: long, score: long>>"
    own = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)).cast("long")
    candidates = rows.select(
        own.alias("block"),
        F.lit(False).alias("is_anchor"),
        "vec_id",
        "label",
        "v",
        F.lit(0).cast("long").alias("print"),
        F.array().cast(limits).alias("limits"),
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.lit(True).alias("is_anchor"),
        "vec_id",
        "label",
        "v",
        "print",
        F.col("limits").cast(limits).alias("limits"),
    )
    both = candidates.unionAll(asked).repartition(blocks, "block")
    return both.sortWithinPartitions("block", "is_anchor", "vec_id")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    scale: int = SCALE,
    block: int = BLOCK,
    leaf: int = LEAF,
    fanout: int = FANOUT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor and each of its first `positives` rows of the same label: the first
    `negatives` rows of other labels whose score is at least `low` per cent of the
    positive's, and no more than it.
    """
    scratch, spark = Scratch(), rows.sparkSession
    rows = scratch.write(participants(rows, scale).distinct(), "negatives-rows")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(tasks, -(-rows.count() // block))
    anchors = rows.where(is_anchor).withColumn("print", F.xxhash64("label", "v"))

    names = ["anchor_id", "print", "vec_id", "score"]
    asked = _dealt(rows, anchors.withColumn("limits", F.array()), blocks)
    schema = ", ".join(f"{name} long" for name in names)
    found = asked.mapInArrow(_search(_positives(positives), names, leaf, fanout), schema)
    order = [F.desc("score"), F.asc("vec_id")]
    place = F.row_number().over(Window.partitionBy("anchor_id", "print").orderBy(*order))
    best = found.withColumn("place", place).where(F.col("place") <= positives)
    limits = best.groupBy(F.col("anchor_id").alias("vec_id"), "print").agg(
        F.collect_list(F.struct("vec_id", "score")).alias("limits")
    )
    limited = scratch.write(anchors.join(limits, ["vec_id", "print"]), "negatives-anchors")

    names = ["anchor_id", "print", "positive_id", "positive_score", "negative_id", "negative_score"]
    schema = ", ".join(f"{name} long" for name in names)
    asked = _dealt(rows, limited, blocks)
    found = asked.mapInArrow(_search(_negatives(negatives, low), names, leaf, fanout), schema)
    order = [F.desc("negative_score"), F.asc("negative_id")]
    own = Window.partitionBy("anchor_id", "print", "positive_id", "positive_score").orderBy(*order)
    return (
        found.withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
