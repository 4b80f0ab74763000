"""Operator 6: toxicity severity by cumulative-link ordinal regression.

Grades 0..3 share one weight vector; P(grade <= k) = sigmoid(theta_k - w.x) with
increasing thresholds. x holds the presence of lower-case words and of their
inner pieces (``PIECE`` letters), hashed to ``SPACE`` features; an L1 penalty keeps
the weights sparse, so common words do not drown the few that matter. The score is the expected severity, the sum of
P(grade > k).

The labels say toxic or not, so training grades come from them: 0 for not toxic;
a toxic document has grade 1, 2 or 3 by how many distinct marker words it holds
(one or none, two, more). Markers are the features whose smoothed log-odds
between toxic and other training documents reach ``MARKER_ODDS`` and that occur
in at least ``MARKER_DOCS`` toxic ones.

Training rows: at most ``TRAIN_ROWS`` documents of each label in hash order (a
bounded, documented sample), weighted back to the classes' true shares.

Cases: null and empty texts have no features; conflicting labels of one id count
as their maximum; null labels and ids never train; with no toxic (or no other)
label every severity is that of the base rate; repeated rows each get their row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import documents, narrow, per_batch, per_document, table

SPACE = 1 << 18
TRAIN_ROWS = 4_000              # of each label
GRADES = 4
MARKER_ODDS = 2.5
MARKER_DOCS = 5
STEPS = 150
RATE = 0.1
LASSO = 1e-4
PIECE = 5
MEMO_LIMIT = 200_000
LONGEST_MEMO_WORD = 40
LEAST_DOCS = 3                  # training documents that a feature must occur in
LEAST_Z = 4.0                   # features less related to the label are left out
MOST_STEP = 1e4                 # bound of a feature's step size in the penalty
PREDICT_AT = 0.5
WORD = re.compile(r"\w+")
RESULT = "doc_id long, severity double, p_toxic double, grade int, predicted int"


_of_word: dict[str, tuple[int, ...]] = {}


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its inner pieces (bounded memo)."""
    found = _of_word.get(word)
    if found is None:
        digest = xxhash.xxh32_intdigest
        found = (digest(word) % SPACE, *(digest(word[k:k + PIECE], 1) % SPACE
                                         for k in range(len(word) - PIECE + 1)))
        if len(_of_word) >= MEMO_LIMIT:
            _of_word.clear()
        if len(word) <= LONGEST_MEMO_WORD:
            _of_word[word] = found
    return found


def features(text: str | None) -> np.ndarray:
    """Sorted hashed features present in a text."""
    found: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        found.update(word_features(word))
    return np.array(sorted(found), dtype=np.int32)


@dataclass
class OrdinalModel:
    weights: np.ndarray             # SPACE
    thresholds: np.ndarray          # GRADES - 1, increasing

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[x].sum(), -30, 30)))


def grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Training grades from labels and marker words."""
    def frequency(on: np.ndarray) -> np.ndarray:
        picked = [rows[i] for i in np.flatnonzero(on)]
        return np.bincount(np.concatenate(picked), minlength=SPACE) if picked else np.zeros(SPACE)

    bad, good = frequency(toxic == 1), frequency(toxic == 0)
    odds = (np.log((bad + 0.5) / ((toxic == 1).sum() + 1))
            - np.log((good + 0.5) / ((toxic == 0).sum() + 1)))
    marker = (odds >= MARKER_ODDS) & (bad >= MARKER_DOCS)
    found = np.array([int(marker[x].sum()) for x in rows], dtype=np.int64)
    return np.where(toxic == 1, np.clip(found, 1, GRADES - 1), 0).astype(np.int64)


def telling(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Which features are at all related to the label: a test of two proportions."""
    def frequency(on: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(on)]), minlength=SPACE)

    bad, good, n, m = frequency(toxic), frequency(~toxic), toxic.sum(), (~toxic).sum()
    share = (bad + good) / (n + m)
    spread = np.sqrt(share * (1 - share) * (1 / n + 1 / m)) + 1e-12
    return (bad + good >= LEAST_DOCS) & (np.abs(bad / n - good / m) >= LEAST_Z * spread)


def fit(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> OrdinalModel:
    """Weighted maximum likelihood with an L1 penalty, by proximal Adam steps.

    Thresholds are kept in order as a first value plus positive steps.
    """
    share = np.cumsum(np.bincount(y, weight, GRADES) + 0.5)[:-1] / (weight.sum() + GRADES / 2)
    start = np.log(share / (1 - share))
    model = OrdinalModel(np.zeros(SPACE), start)
    if len(y) == 0 or y.min() == y.max():
        return model
    rows = [x[keep[x]] for keep in [telling(rows, y > 0)] for x in rows]
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    used, column = np.unique(np.concatenate(rows), return_inverse=True)
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    value = np.concatenate([np.zeros(len(used)), start[:1], gaps])
    first, second = np.zeros_like(value), np.zeros_like(value)
    weight = weight / weight.sum()
    edge = np.zeros((len(y), 2))
    k = len(used)
    for step in range(1, STEPS + 1):
        theta = value[k] + np.append(0, np.cumsum(np.exp(value[k + 1:])))
        z = np.bincount(owner, value[column], len(rows))
        cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - z[:, None], -30, 30)))
        full = np.hstack([np.zeros((len(y), 1)), cdf, np.ones((len(y), 1))])
        edge = np.stack([full[np.arange(len(y)), y], full[np.arange(len(y)), y + 1]], axis=1)
        p = np.maximum(edge[:, 1] - edge[:, 0], 1e-12)
        slope = edge * (1 - edge) / p[:, None] * weight[:, None]      # d log p by lower, upper
        grad = np.empty_like(value)
        grad[:k] = np.bincount(column, (slope[:, 1] - slope[:, 0])[owner], k)
        by_theta = np.array([slope[y == g + 1, 0].sum() - slope[y == g, 1].sum()
                             for g in range(GRADES - 1)])
        grad[k] = by_theta.sum()
        grad[k + 1:] = np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(value[k + 1:])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        size = RATE / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        value -= size * first / (1 - 0.9 ** step)
        w = value[:k]
        w[:] = np.sign(w) * np.maximum(np.abs(w) - LASSO * np.minimum(size[:k], MOST_STEP), 0)
    model.weights[used] = value[:k]
    model.thresholds = value[k] + np.append(0, np.cumsum(np.exp(value[k + 1:])))
    return model


# --------------------------------------------------------------------- Spark

def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` documents of each label, in hash order."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = (known.filter("toxic = 1").orderBy(order, "doc_id").limit(rows)
              .union(known.filter("toxic = 0").orderBy(order, "doc_id").limit(rows)))
    picked = (narrow(docs).join(F.broadcast(chosen), "doc_id")      # at most 2 * rows ids
              .select("doc_id", "text", "toxic"))

    def compute(batch: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, toxic in batch:
            yield doc_id, toxic, features(text).tobytes()

    got = (per_batch(picked, "doc_id long, toxic int, x binary", compute)
           .orderBy("doc_id", "x").limit(2 * rows).collect())
    x = [np.frombuffer(r["x"], dtype=np.int32) for r in got]
    toxic = np.array([r["toxic"] for r in got], dtype=np.int64)
    part = np.maximum(np.bincount(toxic, minlength=2), 1) / max(1, len(toxic))
    true = np.array([shares.get(k, 0) for k in (0, 1)]) / max(1, sum(shares.values()))
    return fit(x, grades(x, toxic), (true / part)[toxic])


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Expected severity, P(toxic), most likely grade and verdict per document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        ordinal = OrdinalModel(*shared.value)
        for doc_id, text in pairs:
            above = ordinal.above(features(text))
            each = -np.diff(np.concatenate([[1.0], above, [0.0]]))
            yield (doc_id, float(above.sum()), float(above[0]), int(each.argmax()),
                   int(above[0] >= PREDICT_AT))

    return per_document(docs, RESULT, rows)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
