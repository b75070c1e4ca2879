"""Quality classifier: naive Bayes features in a linear support vector machine.

Word and word-pair indicators are scaled by the log ratio of their counts in
good and poor documents; a hinge-loss model over the scaled indicators is
fitted by dual coordinate descent, and its margin is calibrated on folds it was
not fitted on, weighted back to the shares of the classes among all labels.

The model is fitted on at most ``per_class`` labelled rows of either class (a
parameter); every document is scored over its whole text.

Contract for unusual input: a null or empty text has no indicators and gets the
score of the model's constant; labels other than 0 and 1 and null ids take no
part in the fit; without labels of both classes every score is the share of
class 1 (0.5 without any); repeated rows are scored each; empty tables give no
rows; further columns of either table are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import words
from riskframe.llm.frames import fold, labelled_sample, logistic, map_column, platt
from riskframe.session import durable

BITS = 18
#: Buckets of a text's shape; these indicators are not scaled down with the text's length.
SHAPES = 64
PER_CLASS = 6000
EPOCHS = 6
COST = 1.0


def shapes(t: words.Tokens, pairs_in_row: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys of a text's shape: how often a word repeats the one before, and how varied its words are.

    Each share is told by its power of two, one indicator each.
    """
    n = np.diff(t.bounds)
    repeats = np.bincount(row[1:][pairs_in_row], minlength=t.rows) if len(row) > 1 else np.zeros(t.rows, int)
    distinct = np.unique(np.stack([row.astype(np.uint64), t.hashes], axis=1), axis=0)[:, 0].astype(np.int64)
    varied = np.bincount(distinct, minlength=t.rows)
    length = np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), 15)
    power = lambda part: np.where(part > 0, np.minimum(np.log2(np.maximum(n, 1) / np.maximum(part, 1)), 14).astype(np.int64), 15)
    rows = np.flatnonzero(n > 0)
    return np.concatenate([rows << BITS | kind[rows] + at for at, kind in
                           ((0, power(repeats)), (16, power(varied)), (32, length))])


def indicators(column: pa.Array):
    """(rows in chunk, row, bucket): distinct hashed words and word pairs of every text, and its shape."""
    for t in words.tokens(column, words.WORDS_AND_MARKS):
        row = t.row_of()
        pair = words.mixed(t.hashes[:-1] * np.uint64(3) + t.hashes[1:]) if len(row) > 1 else t.hashes[:0]
        same = row[1:] == row[:-1]
        at = np.concatenate([row, row[1:][same]])
        hashed = np.concatenate([t.hashes, pair[same]]) >> np.uint64(64 - BITS)
        hashed = np.maximum(hashed.astype(np.int64), SHAPES)
        keys = np.unique((at.astype(np.int64) << BITS) | hashed)
        again = t.hashes[1:] == t.hashes[:-1] if len(row) > 1 else same
        keys = np.sort(np.concatenate([keys, shapes(t, same & again, row)]))
        yield t.rows, keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    """Decision: the constant plus the weights present, those of words over the root of their number."""

    weights: np.ndarray
    constant: float
    slope: float
    offset: float

    def decide(self, rows: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        n = np.bincount(row, minlength=rows)
        scale = np.where(bucket < SHAPES, 1.0, 1 / np.sqrt(np.maximum(n, 1))[row])
        return np.bincount(row, weights=self.weights[bucket] * scale, minlength=rows) + self.constant

    def score(self, column: pa.Array) -> np.ndarray:
        parts = [logistic(self.slope * self.decide(*x) + self.offset) for x in indicators(column)]
        return np.concatenate(parts) if parts else np.zeros(0)


def log_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log ratio of each indicator's smoothed share in class 1 and in class 0."""
    size = 1 << BITS
    share = []
    for c in (1, 0):
        own = [r for r, label in zip(rows, y, strict=True) if label == c]
        count = 1.0 + np.bincount(np.concatenate(own), minlength=size)
        share.append(count / (count.sum()))
    return np.log(share[0] / share[1])


def scaled(row: np.ndarray) -> np.ndarray:
    """The value of each indicator present in one text."""
    return np.where(row < SHAPES, 1.0, 1 / np.sqrt(max(len(row), 1)))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int):
    """Dual coordinate descent for the hinge loss over normalised, ratio-scaled indicators."""
    w, constant = np.zeros(1 << BITS), 0.0
    values = [ratio[r] * scaled(r) for r in rows]
    norms = [float(v @ v) + 1.0 for v in values]
    sign, alpha = 2 * y - 1, np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + constant) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[rows[i]] += step * values[i]
                constant += step
                alpha[i] = new
    return w * ratio, constant


def train(rows: list[np.ndarray], y: np.ndarray, counts: dict[int, int], epochs: int = EPOCHS) -> Model:
    """Fit on all rows; calibrate on two halves, each scored by the fit on the other."""
    total = sum(counts.values())
    if not len(rows) or y.min() == y.max():
        share = counts[1] / total if total else 0.5
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(p / (1 - p))))
    taken = np.bincount(y, minlength=2)
    balance = len(y) / (2 * taken[y])

    def fit(some: np.ndarray):
        own = [rows[i] for i in some]
        return descend(own, y[some], log_ratio(own, y[some]), COST * balance[some], epochs)

    decided = np.zeros(len(y))
    halves = np.zeros(len(y), bool)
    for c in (0, 1):
        halves[np.flatnonzero(y == c)[::2]] = True
    for half in (halves, ~halves):
        if len(set(y[~half])) < 2:
            continue
        w, constant = fit(np.flatnonzero(~half))
        for i in np.flatnonzero(half):
            decided[i] = w[rows[i]] @ scaled(rows[i]) + constant
    weight = np.array([counts[c] / taken[c] for c in (0, 1)])[y] / total * len(y)
    slope, offset = platt(decided, y, weight)
    w, constant = fit(np.arange(len(y)))
    return Model(w, constant, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, doc_id: str = "doc_id",
        text: str = "text") -> Model:
    """A model of ``label`` from the labelled documents; the sample and the model have fixed sizes."""
    sample, counts = labelled_sample(labels, doc_id, label, per_class)
    texts = docs.select(doc_id, text).join(F.broadcast(durable(sample)), doc_id)

    def make(column: pa.Array) -> list:
        out = []
        for rows, row, bucket in indicators(column):
            cut = np.searchsorted(row, np.arange(1, rows))
            out += [x.astype(np.int32).tobytes() for x in np.split(bucket, cut)]
        return [pa.array(out, pa.binary())]

    held = map_column(texts, text, ["label"], [("buckets", T.BinaryType())], make)
    schema = "weights binary, constant double, slope double, offset double"

    def one_task(batches):
        rows, y = [], []
        for batch in batches:
            y += batch.column(0).to_pylist()
            rows += [np.frombuffer(x.as_py(), np.int32) for x in batch.column(1)]
        order = sorted(range(len(y)), key=lambda i: (y[i], len(rows[i]), rows[i].tobytes()))
        m = train([rows[i] for i in order], np.array([y[i] for i in order], dtype=np.int64), counts)
        yield pa.RecordBatch.from_pylist(
            [{"weights": m.weights.tobytes(), "constant": m.constant, "slope": m.slope, "offset": m.offset}]
        )

    # The bounded sample is small enough for one task; nothing else is gathered there.
    r = durable(held).coalesce(1).mapInArrow(one_task, schema).first()
    if r is None:
        return train([], np.zeros(0, np.int64), counts)
    return Model(np.frombuffer(bytes(r["weights"])), r["constant"], r["slope"], r["offset"])


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """(keep..., score): every document's calibrated probability of class 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of 2^18 weights
    return map_column(docs, text, keep, [(out, T.DoubleType())],
                      lambda column: [pa.array(shared.value.score(column), pa.float64())])


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0,
             threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of the held-out fold are not read."""
    model = fit(docs, labels.where(fold(doc_id, folds) != held), label, doc_id=doc_id, text=text)
    return score(docs, model, [doc_id], text).select(
        doc_id, (fold(doc_id, folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
