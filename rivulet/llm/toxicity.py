"""Toxicity by a classifier chain over hashed words.

The labels say toxic or not; what kind of toxicity is learned from them as three
categories, predicted one after the other:

  insult   the document holds a feature (a word, or the beginning of words) that is
           typical of toxic documents and all but absent from others;
  severe   it holds more such features than the middle one of the toxic documents;
  toxic    the label itself.

Each link of the chain is a logistic regression over the features and the probabilities
of all earlier categories. While fitting, those probabilities are out of fold: each row's
comes from weights that were not fitted on it, so later models learn how far to trust
earlier ones. (Which features there are, and what is typical, is chosen over all rows.)
Scoring uses the models fitted on all rows.

The models are fitted on at most SAMPLE labelled rows, the first by a hash of the id;
their sparse features travel to the driver, never texts. Features are the FEATURES
buckets that tell toxic rows from others best, so a model is a few hundred numbers; it is
broadcast and all documents are scored in one pass without a shuffle.

Defined cases: a null or empty text has no features and is scored by the intercepts
alone. Rows whose label is null are not learned from; repeated labels count each. Without
rows of both kinds nothing is toxic (all probabilities 0). Null ids and repeated rows are
scored like any other; other columns are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import features as X, words as W

SAMPLE = 10_000
FEATURES = 256
FOLDS = 5
CATEGORIES = ("insult", "severe", "toxic")
THRESHOLD = 0.5


@dataclass
class Chain:
    """Feature buckets, and by category the weights: features, earlier ones, intercept."""

    buckets: np.ndarray
    typical: np.ndarray
    weights: list[np.ndarray]

    def features(self, texts: pa.Array) -> np.ndarray:
        found, bounds = X.buckets(texts)
        return self.matrix(found, bounds)

    def matrix(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bounds) - 1, len(self.buckets)))
        if len(self.buckets):
            place = np.searchsorted(self.buckets, found)
            place[place == len(self.buckets)] = 0
            hit = np.flatnonzero(self.buckets[place] == found)
            out[np.searchsorted(bounds, hit, "right") - 1, place[hit]] = 1
        return out

    def probabilities(self, matrix: np.ndarray) -> np.ndarray:
        """One column for each category, in the order of the chain."""
        out = np.zeros((len(matrix), len(CATEGORIES)))
        for k, weights in enumerate(self.weights):
            out[:, k] = X.sigmoid(np.column_stack([matrix, out[:, :k]]) @ weights[:-1] + weights[-1])
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 15) -> np.ndarray:
    """Weights and intercept of a regularised logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = X.sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, gradient)
        w -= move
        if np.abs(move).max() < 1e-4:
            break
    return w


def _select(rows: list[np.ndarray], y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that tell toxic rows best, sorted, and which of them are typical."""
    def counted(chosen: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        return np.bincount(flat, minlength=X.BUCKETS).astype(float)

    toxic, clean = int(y.sum()), int((1 - y).sum())
    a = counted([r for r, t in zip(rows, y, strict=True) if t])
    b = counted([r for r, t in zip(rows, y, strict=True) if not t])
    ratio = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
    gain = (a / max(toxic, 1) - b / max(clean, 1)) * ratio
    gain[a < max(3, 0.002 * toxic)] = 0
    best = np.sort(np.argsort(-gain, kind="stable")[:most])
    best = best[gain[best] > 0]
    typical = (a[best] / max(toxic, 1) > 20 * (b[best] + 0.5) / max(clean, 1))
    return best, typical


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most: int = SAMPLE,
    n_features: int = FEATURES,
    folds: int = FOLDS,
) -> Chain:
    """A chain fitted on at most `most` labelled documents."""
    named = labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic")
    rows = X.sample(named.withColumn("text", F.lit("")), most).select("doc_id", "toxic")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, most=1 << 20):
            found, bounds = X.buckets(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), lists],
                names=["doc_id", "toxic", "found"],
            )

    got = (
        docs.select("doc_id", "text")
        .join(rows, "doc_id")
        .select("doc_id", "toxic", "text")
        .mapInArrow(featurise, "doc_id long, toxic int, found array<int>")
    )
    ids, y, found = [], [], []
    for row in got.toArrow().to_batches():  # at most `most` rows of sparse features
        ids += row.column("doc_id").to_pylist()
        y += row.column("toxic").to_pylist()
        found += [x.values.to_numpy(zero_copy_only=False) for x in row.column("found")]
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    y = (np.array(y, np.int64) > 0).astype(int)[order]
    found = [found[i] for i in order]
    ids = [ids[i] for i in order]
    if not y.any() or y.all():
        return Chain(np.empty(0, np.int64), np.empty(0, bool), [])
    buckets, typical = _select(found, y, n_features)
    chain = Chain(buckets, typical, [])
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in found])))
    matrix = chain.matrix(np.concatenate(found).astype(np.int64), bounds)
    hits = matrix[:, typical].sum(1)
    middle = np.median(hits[y == 1])
    targets = [(hits > 0).astype(int), ((hits > middle) & (y == 1)).astype(int), y]
    fold = X.stable_fold(ids, folds)
    earlier = np.zeros((len(y), 0))
    for target in targets:
        x = np.column_stack([matrix, earlier])
        out = np.zeros(len(y))
        for f in range(folds):
            held = fold == f
            if held.any() and not held.all():
                w = logistic(x[~held], target[~held])
                out[held] = X.sigmoid(x[held] @ w[:-1] + w[-1])
        chain.weights.append(logistic(x, target))
        earlier = np.column_stack([earlier, out])
    return chain


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id and the probability of each category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, most=1 << 20):
            found = shared.value.probabilities(shared.value.features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *map(pa.array, found.T)],
                names=["doc_id", *CATEGORIES],
            )

    columns = ", ".join(f"{c} double" for c in CATEGORIES)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {columns}")


def clean(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic; all their columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, most=1 << 20):
            found = shared.value.probabilities(shared.value.features(batch.column("text")))
            yield batch.filter(pa.array(found[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
