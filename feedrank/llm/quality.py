"""Operator 4: quality classifier, an additive model with pairwise interactions.

Each text becomes ``FEATURES`` (shape, repetition, symbols; never its label,
language, source or id). Every feature has a lookup table over its bins and the
strongest pairs have two-dimensional ones. Training boosts shallow trees on the
logistic loss, one feature after another in cycles: a tree reads the gradient
histogram of its feature, splits it at most three times, and its leaf values are
added to that feature's table. Pairs are ranked by how much a tree over both
reduces the loss left by the single tables, then boosted in cycles the same way.
A score is a sum of table look-ups, done for whole batches with array indexing.

Training rows: labelled documents outside the hold-out fold, at most
``TRAIN_ROWS`` of them in hash order (a bounded, documented sample); features
are computed for those rows only. Scoring is one pass over all texts without a
shuffle.

Cases: null and empty texts have all-zero counts and are scored; conflicting
labels of one id count as their minimum; ids without label, null labels and null
ids never train; with no labels, or one class only, every score is the smoothed
share of good labels (0.5 without any); repeated rows each get their row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import WORD_SPACE, arrow_schema, documents, narrow, per_batch, table

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 60
PAIR_ROUNDS = 30
RATE = 0.15
LEAST_WEIGHT = 2.0      # hessian sum a leaf needs
SHRINK = 1.0            # added to a leaf's hessian sum

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "log_words", "word_length", "symbol_share", "digit_share", "upper_share", "bang_share",
    "stop_share", "comma_share", "distinct_share", "top_word_share", "pair_repeat_share",
    "triple_repeat_share", "same_next_share", "dup_line_share", "line_words", "short_line_share",
    "one_char_share", "other_share",
)
_DIGITS, _UPPER = b"0123456789", bytes(range(65, 91))
_PLAIN = bytes(range(97, 123)) + bytes(range(65, 91)) + _DIGITS + WORD_SPACE.encode() + b".,!?'\"-"


def features(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one whole text."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if n == 0:
        return [0.0] * len(FEATURES)
    chars = len(text) - sum(map(text.count, WORD_SPACE))
    seen = Counter(words)
    pairs = set(zip(words, words[1:]))
    triples = set(zip(words, words[1:], words[2:]))
    lines = [s for line in text.split("\n") if (s := line.strip(WORD_SPACE))]
    per_line = [s.count(" ") + 1 for s in lines]

    def share(drop: bytes) -> float:
        return (len(raw) - len(raw.translate(None, drop))) / size

    return [
        math.log(n), chars / n,
        sum(map(text.count, SYMBOLS)) / chars,
        share(_DIGITS), share(_UPPER), text.count("!") / n, text.count(".") / n,
        text.count(",") / n, len(seen) / n, max(seen.values()) / n,
        1 - len(pairs) / max(1, n - 1) if n > 1 else 0.0,
        1 - len(triples) / max(1, n - 2) if n > 2 else 0.0,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), n / len(lines),
        sum(k < 3 for k in per_line) / len(lines),
        sum(len(w) == 1 for w in words) / n,
        len(raw.translate(None, _PLAIN)) / size,
    ]


# --------------------------------------------------------------------- model

@dataclass
class AdditiveModel:
    """Intercept, bin edges, a table per feature and a table per chosen pair."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)      # bin -> pair bin, a feature
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right")
                         for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of feature values."""
        total = np.full(len(x), self.base)
        if self.edges:
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                total += t[b[:, j]]
            for (i, j), t in zip(self.pairs, self.pair_tables):
                total += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best cut of a histogram: (gain, first bin of the right side)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gains = _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum())
    gains[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = 0
    if not len(gains) or gains.max() <= 1e-9:
        return 0.0, 0
    return float(gains.max()), int(gains.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value for each bin of a tree of ``depth`` over one histogram."""
    gain, cut = _split(g, h) if depth else (0.0, 0)
    if not cut:
        return np.full(len(g), -g.sum() / (h.sum() + SHRINK))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Tree over a 2-d histogram: one cut on one axis, then one on the other."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, a.shape[0]):
            total, value = -_gain(a.sum(), b.sum()), np.zeros_like(a)
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = a[rows].sum(axis=0), b[rows].sum(axis=0)
                value[rows] = _tree(gs, hs, 1)
                part = _split(gs, hs)[0]
                total += part + _gain(gs.sum(), hs.sum())
            if total > best[0]:
                best = (float(total), value.T if turned else value)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Train on a bounded sample of feature rows and 0/1 labels."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(base=float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    k = x.shape[1]
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], steps)) for j in range(k)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(t)) * PAIR_BINS // len(t) for t in model.tables]
    b = model.bins(x)
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)))
            t += step
            total += step[b[:, j]]

    small = np.stack([c[b[:, j]] for j, c in enumerate(model.coarse)], axis=1)

    def histogram(i: int, j: int, w: np.ndarray) -> np.ndarray:
        cell = small[:, i] * PAIR_BINS + small[:, j]
        return np.bincount(cell, w, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)

    g, h = slopes()
    ranked = sorted(((_pair_tree(histogram(i, j, g), histogram(i, j, h))[0], i, j)
                     for i in range(k) for j in range(i + 1, k)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * _pair_tree(histogram(i, j, g), histogram(i, j, h))[1]
            t += step
            total += step[small[:, i], small[:, j]]
    return model


# --------------------------------------------------------------------- Spark

def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the hold-out fold."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("quality").cast("int").alias("y"))
              .filter("doc_id is not null and y is not null").filter(fold() != 0)
              .groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    picked = narrow(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")

    def compute(batch: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, y in batch:
            yield doc_id, y, features(text)

    got = (per_batch(picked, "doc_id long, y int, x array<double>", compute)
           .orderBy("doc_id", "x").limit(rows).collect())       # at most ``rows`` rows
    return fit(np.array([r["x"] for r in got]).reshape(-1, len(FEATURES)),
               np.array([r["y"] for r in got], dtype=float))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""

    def compute(batch: Iterator[tuple]) -> Iterator[tuple]:
        ids, rows = [], []
        for doc_id, text in batch:
            ids.append(doc_id)
            rows.append(features(text))
        if ids:
            yield from zip(ids, model.score(np.array(rows)).tolist())

    return per_batch(narrow(docs), "doc_id long, score double", compute)


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    arrow_schema(docs.sparkSession, "doc_id long")              # ships the package
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([features(t.as_py()) for t in batch.column(at)])
                yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
