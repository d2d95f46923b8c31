"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a weighted sum of text features.  The weights are
learned from preference pairs: in each pair a document labelled 1 is
preferred to one labelled 0, and the logistic loss of the difference of
their features is minimised (with a small ridge), by Newton steps.  The
cut lies at a quantile of the training documents' worths: the share of
label 0, moved by at most ``NEAR`` to where the labels separate best.  A
score is the logistic function of the worth, shifted so that the cut has
the score ``CUT``; a document is taken if its score reaches it.

Features come from the whole text alone: shares of byte classes, lengths of
words and lines, repetition, and edge punctuation, all bounded.  A null
text counts as empty; an empty text has a row of features like any other.

The fit runs on the driver over the features of at most ``MAX_LABELLED``
labelled documents (those with the smallest hash of the id; their ids and
labels are broadcast, which the bound allows), never on texts; scoring is
one pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import id_remainder

MAX_LABELLED = 20_000       # labelled documents that the fit sees
PAIRS_PER_LOSER = 16        # preferred documents that each rejected one meets
RIDGE = 1e-2
CUT = 0.3
SHARPNESS = 1.0
NEAR = 0.02                 # share of the training documents that the cut may lie off label 0's share

_CLASSES = np.zeros(256, dtype=np.int64)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
                           b"\n", b"\t\x0b\x0c\r", b".,;:", b"!?", b"|", b"#$%&*", b"\"'()-",
                           b"@/\\<>[]{}=+^~_`"), 1):
    _CLASSES[list(_set)] = _i
_CLASSES[128:] = 13
N_CLASSES = 14


def features(text: bytes | None) -> list[float]:
    """The feature row of a text."""
    text = text or b""
    n = max(1, len(text))
    kinds = np.bincount(_CLASSES[np.frombuffer(text, np.uint8)], minlength=N_CLASSES) / n
    words = text.split()
    n_words = len(words)
    w = max(1, n_words)
    lines = text.split(b"\n")
    n_lines = len(lines)
    distinct = len(set(words)) / w
    repeated = sum(a == b for a, b in zip(words, words[1:])) / w
    tail = np.frombuffer(b"".join([x[-1:] for x in words]), np.uint8)
    ends = np.bincount(_CLASSES[tail], minlength=N_CLASSES) / w
    long_words = sum(len(x) > 20 for x in words) / w
    line_set = len(set(lines)) / n_lines
    size = math.log1p(n_words)
    return [*kinds.tolist(), *ends[[1, 2, 3, 7, 8, 9, 10]].tolist(), distinct, distinct * size, repeated,
            min(1.0, len(text) / w / 20), long_words, line_set, math.log1p(n_words / n_lines), size,
            math.sqrt(repeated), math.sqrt(kinds[8]), math.sqrt(kinds[9]), math.sqrt(kinds[2]), math.sqrt(kinds[7])]


N_FEATURES = len(features(None))


@dataclass
class Model:
    """worth = (x - mean) / spread . weights; score = logistic(sharpness *
    (worth - cut) + logit(CUT))."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(SHARPNESS * (self.worth(x) - self.cut), -500, 500)
        return 1.0 / (1.0 + (1.0 - CUT) / CUT * np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = 12) -> Model:
    """Learn from feature rows and labels (1 preferred).  Without both labels
    there is no pair: every document then scores as its one label says."""
    if not len(x):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), -1.0)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - mean) / spread, -8, 8)
    win, lose = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    weights = np.zeros(x.shape[1])
    if not len(win) or not len(lose):
        return Model(mean, spread, weights, -1.0 if len(win) else 1.0)
    rng = np.random.default_rng(seed)
    a = np.repeat(lose, PAIRS_PER_LOSER)
    b = win[rng.integers(0, len(win), len(a))]
    # every preferred document meets a rejected one as well
    a, b = np.concatenate([a, lose[rng.integers(0, len(lose), len(win))]]), np.concatenate([b, win])
    diff = z[b] - z[a]
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(diff @ weights, -30, 30)))
        grad = diff.T @ (p - 1.0) / len(diff) + RIDGE * weights
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(weights))
        weights = weights - np.linalg.solve(hess, grad)
    worth = z @ weights
    # the gap of least error near the quantile of label 0's share
    order = np.argsort(worth, kind="stable")
    wrong = np.concatenate([[0], np.cumsum(np.where(y[order] == 1, 1.0, 0.0))]) \
        + np.concatenate([np.cumsum(np.where(y[order][::-1] == 0, 1.0, 0.0))[::-1], [0]])
    near = math.ceil(NEAR * len(order))
    first = max(0, len(lose) - near)
    at = first + int(np.argmin(wrong[first:len(lose) + near + 1]))
    low = worth[order[max(0, at - 1)]]
    high = worth[order[min(len(order) - 1, at)]]
    return Model(mean, spread, weights, float((low + high) / 2))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = 5) -> Model:
    """Fit on labelled documents whose crc32(id) mod ``folds`` is not 0.
    Repeated label rows of an id count once, with the larger label; of repeated
    documents of an id, the smallest feature row counts, so what reaches the
    driver is bounded by ``MAX_LABELLED`` however often an id repeats."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .where(id_remainder(F.col(id_col), folds) != 0)
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1),
                                   pa.array([features(t.as_py()) for t in b.column(2)], pa.list_(pa.float64()))],
                                  names=["doc_id", "label", "x"])

    rows = (_rows(docs, id_col, text_col).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
            .mapInArrow(run, "doc_id long, label int, x array<double>")
            .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("x").alias("x")))
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, N_FEATURES)
    return fit(x, got["label"].to_numpy())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)]).reshape(-1, N_FEATURES)
            yield pa.record_batch([b.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the cut, all columns."""

    @F.pandas_udf("double")
    def reached(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text]).reshape(-1, N_FEATURES)
        return pd.Series(model.score(x))

    return docs.where(reached(F.col(text_col).cast("binary")) >= CUT)
