"""Document quality by positive-unlabelled learning.

Good documents are trusted positives; everything else, rejected or never looked at, is
unlabelled. The classifier minimises the non-negative unbiased risk: with prior p of good
documents, the loss of calling positives good, p R+(f), plus the loss of calling the
unlabelled bad less that of calling positives bad, |R-(f) - p R+-(f)|. With the logistic
loss the unbiased risk is convex; a step that would take the second part below zero is
shortened, so the model cannot learn the unlabelled documents by heart. The prior is
estimated from positives and unlabelled documents alone: a first classifier of the one
against the other gives every document a score, and the share of unlabelled documents above
a score is at least the prior times the share of positives above it; high scores, which few
bad documents reach, give the closest bounds, and their mean is taken.

The positives are at most SAMPLE labelled rows, the first by a hash of the id. Everything
unlabelled counts over all documents that `learn` allows: the steps of the features, the
shares above a score, and the gradient and value of the risk, each of them one aggregation
over a written table of the documents' shapes. Both fits start from a sample of that table,
whose curvature also scales their steps; they end where the gradient over all documents does.

Features are numbers of a document's shape (case, marks, repetition, lengths of words and
lines), computed over the whole text; labels, language, source and id are not among them.
Scoring is one pass over the documents with a few hundred broadcast numbers.

Defined cases: a null or empty text has the shape of nothing: all features 0. Rows with a
null label or id are not learned from. Without positives every score is 0.5. Null ids are
held out of nothing (held_out null counts as false). Repeated rows are unlabelled rows, and
scored, one by one; a positive counts once. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm import features as X, words as W
from rivulet.llm.scratch import Scratch

SAMPLE = 10_000
THRESHOLD = 0.3
RIDGE = 0.1
NEWTON = 12  # steps on the sample
PASSES = 8  # over all documents, at most
ROUGH = 2  # where only the order of the scores counts
ENOUGH = 1e-4  # of the largest part of the gradient
NAMES = (
    "log_words", "mean_word", "long_words", "upper", "digit", "mark", "odd_mark", "bar",
    "exclaim", "distinct", "repeat_next", "repeat_pair", "lines", "repeat_line",
    "stop_end", "capital_start", "word_spread",
)


def shapes(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each text."""
    alphabet = W.blank_separated(fold=True)
    split = W.split(texts, alphabet)
    hashes = split.hashes(alphabet)
    n = np.maximum(split.counts, 1).astype(float)
    size = np.maximum(np.diff(split.offsets), 1).astype(float)
    some = split.counts > 0

    def share_of_bytes(inside: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(inside[split.buffer])))
        return np.diff(total[split.offsets]) / size

    def sum_of_words(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(values)))
        return total[split.first[1:]] - total[split.first[:-1]]

    def group(symbols: bytes) -> np.ndarray:
        out = np.zeros(256, bool)
        out[list(symbols)] = True
        return out

    length = (split.end - split.start).astype(float)
    mean = sum_of_words(length) / n
    spread = np.sqrt(np.maximum(sum_of_words(length * length) / n - mean * mean, 0))
    document = split.document()
    next_ = np.zeros(len(hashes))
    pair = np.zeros(len(hashes))
    if len(hashes) > 1:
        next_[1:] = (hashes[1:] == hashes[:-1]) & (document[1:] == document[:-1])
    if len(hashes) > 2:
        pair[2:] = (hashes[2:] == hashes[:-2]) & (document[2:] == document[:-2])
    distinct = _distinct(document, hashes, len(texts))
    line = W.Alphabet.of(~group(b"\n\r"), fold=True)
    lines = W.split(texts, line)
    kept = np.maximum(lines.counts, 1).astype(float)
    different = _distinct(lines.document(), lines.hashes(line), len(texts))
    first = split.buffer[split.start] if len(split.start) else np.empty(0, np.uint8)
    last = split.buffer[split.end - 1] if len(split.end) else np.empty(0, np.uint8)
    letters = group(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b" \n\r\t")
    usual = letters | group(b".,;:'\"()-0123456789")
    columns = [
        np.log1p(split.counts),
        mean,
        sum_of_words((length > 18).astype(float)) / n,
        share_of_bytes(group(bytes(range(65, 91)))),
        share_of_bytes(group(b"0123456789")),
        share_of_bytes(~letters),
        share_of_bytes(~usual),
        share_of_bytes(group(b"|")),
        share_of_bytes(group(b"!")),
        np.where(some, distinct / np.sqrt(n), 0),
        sum_of_words(next_) / n,
        sum_of_words(pair) / n,
        np.log1p(lines.counts) - np.log1p(split.counts),
        np.where(lines.counts > 0, 1 - different / kept, 0),
        sum_of_words((last == 46).astype(float)) / n,
        sum_of_words(((first >= 65) & (first <= 90)).astype(float)) / n,
        spread,
    ]
    return np.column_stack(columns) * some[:, None]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each owner has; 40 bits of them decide."""
    keys = np.unique((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    return np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=n)


@dataclass
class Model:
    """Steps over the features, and the weights of the steps."""

    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, shape: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(shape), self.prior)
        return X.sigmoid((stepped(shape, self.edges) @ self.weights + self.bias).astype(float))


def stepped(shape: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Each feature as the quantiles it has passed: lets a linear model bend."""
    return np.column_stack(
        [(shape[:, k : k + 1] > e[None, :]).astype(np.float32) for k, e in enumerate(edges)]
    )


# --- risks: a part over unlabelled documents, a part over positives -----------


def _with_bias(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x), np.float32)])


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class Risk:
    """`share` times the mean over unlabelled rows of log(1 + e^z), plus that of positives.

    With a prior the positives' part is -prior z, as the unbiased risk has it; without one
    it is (1 - share) log(1 + e^-z), which tells positives from unlabelled rows.
    """

    positive: np.ndarray  # stepped, with a last column of ones
    share: float
    prior: float | None = None
    ridge: float = RIDGE

    def __post_init__(self) -> None:
        self.pull = np.append(np.full(self.positive.shape[1] - 1, self.ridge), 0)

    def gradient(self, w: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
        """`unlabelled` is the mean of sigmoid(z) x."""
        p, z = self.positive, self.positive @ w
        if self.prior is None:
            own = (1 - self.share) * p.T @ (X.sigmoid(z) - 1) / len(p)
        else:
            own = -self.prior * p.mean(0)
        return self.share * unlabelled + own + self.pull * w

    def curvature(self, w: np.ndarray, sample: np.ndarray) -> np.ndarray:
        def mean(x: np.ndarray) -> np.ndarray:
            s = X.sigmoid(x @ w)
            return (x * (s * (1 - s))[:, None]).T @ x / len(x)

        out = self.share * mean(sample) + np.diag(self.pull + 1e-6)
        return out + (1 - self.share) * mean(self.positive) if self.prior is None else out

    def rest(self, w: np.ndarray, unlabelled: float) -> float:
        """The risk of what is left of the unlabelled rows without the positives among them."""
        if self.prior is None:
            return unlabelled
        return unlabelled - self.prior * float(_softplus(self.positive @ w).mean())


def _sums(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums of sigmoid(z) x, of log(1 + e^z), and of rows."""
    z = x @ w
    return np.concatenate([x.T @ X.sigmoid(z), [_softplus(z).sum(), len(x)]])


def _aggregated(shaped: DataFrame, of, size: int) -> np.ndarray:
    """`of(shapes)`, `size` sums, over all rows: added up in each task and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += of(_matrix(batch.column("shape")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(total)], names=["place", "value"]
        )

    sums = shaped.select("shape").mapInArrow(run, "place long, value double")
    out = np.zeros(size)
    for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[row["place"]] = row["value"]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def minimised(
    shaped: DataFrame, rows_of, risk: Risk, sample: np.ndarray, passes: int = PASSES
) -> np.ndarray:
    """Weights of the least risk over all rows of `shaped`, or as near as the passes come.

    `rows_of` turns shapes into rows of the model; `sample` has some of those.
    """
    w = np.zeros(risk.positive.shape[1])
    for _ in range(NEWTON):  # on the sample, to start near the end
        means = _sums(sample, w)
        step = np.linalg.solve(
            risk.curvature(w, sample), risk.gradient(w, means[:-2] / len(sample))
        )
        w = w - step * min(1, 4 / max(1e-9, np.abs(step).max()))
    before = None
    for _ in range(passes):
        here = w

        def of(shape: np.ndarray) -> np.ndarray:
            return _sums(rows_of(shape), here)

        sums = _aggregated(shaped, of, len(w) + 2)
        rest = risk.rest(w, sums[-2] / sums[-1])
        if rest < 0 and before is not None:
            w = (w + before) / 2  # part of the way back to where it was not negative
            continue
        gradient = risk.gradient(w, sums[:-2] / sums[-1])
        if rest < 0 or np.abs(gradient).max() < ENOUGH:
            break
        before, w = w, w - np.linalg.solve(risk.curvature(w, sample), gradient)
    return w


def estimated_prior(
    shaped: DataFrame, rows_of, positive: np.ndarray, sample: np.ndarray
) -> float:
    """An upper bound on the share of positives among all rows, from their scores.

    Positives are scored by a classifier that has not seen them: half of them each time.
    """
    bounds = []
    for half in (0, 1):
        seen, unseen = positive[half::2], positive[1 - half :: 2]
        if not len(seen) or not len(unseen):
            seen = unseen = positive
        w = minimised(shaped, rows_of, Risk(seen, 0.5), sample, ROUGH)
        scores = unseen @ w
        places = np.quantile(scores, np.linspace(0.5, 0.75, 6))
        above = _aggregated(shaped, _above(rows_of, w, places), len(places) + 1)
        quotient = above[:-1] / above[-1] / [(scores >= s).mean() for s in places]
        bounds.append(quotient.mean())  # the least of them would lean on chance
    return float(np.clip(np.mean(bounds), 0.05, 0.95))


def _above(rows_of, w: np.ndarray, places: np.ndarray):
    """How many rows score at least each of the places, and how many there are."""

    def of(shape: np.ndarray) -> np.ndarray:
        found = np.sort(rows_of(shape) @ w)
        return np.append(len(found) - np.searchsorted(found, places), len(found))

    return of


def _shaped(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, most=1 << 20):
            found = shapes(batch.column("text"))
            bounds = pa.array(np.arange(len(found) + 1) * len(NAMES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(found.reshape(-1))),
                ],
                names=["doc_id", "shape"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shape array<double>")


def _collected(rows: DataFrame, most: int) -> np.ndarray:
    """Shapes of the first rows by a hash of the id; no more than `most`."""
    order = [F.xxhash64(F.lit(11), "doc_id"), F.col("doc_id"), F.xxhash64("shape")]
    got = rows.orderBy(*order).limit(most).select("shape").toArrow()
    return _matrix(got.column("shape").combine_chunks()) if len(got) else np.empty((0, len(NAMES)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, most: int = SAMPLE) -> Model:
    """A model from the positives that `learn` allows and all documents that it allows."""
    scratch = Scratch()
    shaped = scratch.write(_shaped(docs.where(learn & F.col("doc_id").isNotNull())), "shapes")
    good = labels.where(learn & F.col("doc_id").isNotNull() & (F.col("quality") == 1))
    good = scratch.write(good.select("doc_id").distinct(), "positives")
    trusted = shaped.join(good, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    positive, sample = _collected(trusted, most), _collected(shaped, most)
    if not len(positive):
        return Model([], np.empty(0), 0.0, 0.5)
    places = np.linspace(0, 0.98, 25).tolist()
    quantiles = shaped.agg(
        *[F.percentile_approx(F.col("shape")[k], places).alias(name) for k, name in enumerate(NAMES)]
    ).first()
    edges = [np.unique(np.array(column, float)) for column in quantiles]

    def rows_of(shape: np.ndarray) -> np.ndarray:
        return _with_bias(stepped(shape, edges)).astype(float)

    p, u = rows_of(positive), rows_of(sample)
    prior = estimated_prior(shaped, rows_of, p, u)
    w = minimised(shaped, rows_of, Risk(p, 1.0, prior), u)
    # the ridge has drawn all scores together: the same risk sets how far apart they lie
    spread = minimised(
        shaped,
        lambda shape: _with_bias(rows_of(shape) @ w),
        Risk(_with_bias(p @ w), 1.0, prior, 1e-6),
        _with_bias(u @ w),
    )
    scratch.discard()
    return Model(edges, spread[0] * w[:-1], float(spread[0] * w[-1] + spread[1]), prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, most=1 << 20):
            found = shared.value.score(shapes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(found),
                    pa.array((found >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
