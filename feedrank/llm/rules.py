"""Operator 8: quality rules with risk-controlled thresholds.

Rules are rates computed from whole texts (``RULES``); a document is rejected
when a rate exceeds the cutoff of its stratum (language). Cutoffs are chosen on
labelled good documents so that false rejection stays limited: for stratum s,
rule r and grid cutoff c, H0 says "more than ALPHA / #rules of the good documents
of s exceed c". Its exact p-value is the binomial probability of seeing at most
the observed number of rejections; H0 is dropped at DELTA / #tests (Bonferroni
over strata, rules and cutoffs). The strictest cutoff that passes is used, and a
rule without one stays off in that stratum. So with probability 1 - DELTA, every
stratum loses at most ALPHA of its good documents to the rules.

Counts per stratum are sums over all labelled documents; the tests run on these
one-row-per-stratum sums and the cutoffs are joined back, nothing is collected.

Cases: null and empty texts have no words and fail the base rule; a null
language is a stratum of its own; several label rows of one id count as their
minimum; unlabelled strata have no cutoffs; repeated rows each get their row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import (WORD_SPACE, arrow_schema, documents, per_batch, stored, table)

ALPHA = 0.02            # limit of false rejection in each stratum
DELTA = 0.05            # probability that any limit is broken
SYMBOLS = "#*$%&|<>"    # fixed value
MIN_WORDS = 50          # fixed value
MAX_REPEAT_PERCENT = 50  # fixed value

# rule -> (numerator, denominator, cutoffs from strict to loose)
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (0.005, 0.01, 0.02, 0.05, 0.1, 0.2)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeats": ("n_repeat_words", "n_words", (0.05, 0.1, 0.2, 0.3, 0.4, 0.5)),
    "word_length": ("word_chars", "n_words", (6.0, 8.0, 10.0, 12.0, 16.0, 24.0)),
}
STATS = ("doc_id long, stratum string, n_words long, word_chars long, n_symbols long, "
         "n_dup_lines long, n_repeat_words long, n_lines long")


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = text or ""
    words = text.encode("utf-8").split()
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        marked = bytearray(n)
        for i, w in enumerate(windows):
            if seen[w] > 1:
                marked[i:i + 3] = b"\1\1\1"
        repeated = sum(marked)
    lines = [line for line in text.split("\n") if line.strip(WORD_SPACE)]
    return (n, len(text) - sum(map(text.count, WORD_SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated, len(lines))


def statistics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Rule statistics of every document."""

    def rows(batch: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, group in batch:
            yield doc_id, group, *text_stats(text)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         F.col(stratum).cast("string").alias("stratum"))
    return per_batch(picked, STATS, rows)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rate(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly term by term."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    head = math.lgamma(n + 1)
    logs = [head - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def strictest(n: int, rejected: Iterable[int], cutoffs: Iterable[float], alpha: float,
              level: float) -> float | None:
    """First cutoff (strict to loose) whose false rejection is surely below alpha."""
    for k, cutoff in zip(rejected, cutoffs):
        # beyond the mean the p-value is over a third: no need to sum it
        if k < alpha * n and at_most(k, n, alpha) <= level:
            return cutoff
    return None


def cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA,
            delta: float = DELTA) -> DataFrame:
    """``for_stratum`` and one cutoff column a rule (null: the rule is off)."""
    good = (labels.select(F.col("doc_id").cast("long").alias("label_id"),
                          F.col("quality").cast("int").alias("y"))
            .filter("label_id is not null and y is not null")
            .groupBy("label_id").agg(F.min("y").alias("y")).filter("y = 1"))
    held = (stats.filter(~base_failed()).join(good, F.col("doc_id") == F.col("label_id")))
    sums = held.groupBy(F.col("stratum").alias("for_stratum")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.array(*[F.count_if(rate(r) > c) for c in RULES[r][2]]).alias(r) for r in RULES])
    counted = stored(sums, "rule-counts")
    strata = counted.count()
    level = delta / max(1, strata * sum(len(x[2]) for x in RULES.values()))
    share = alpha / len(RULES)
    schema = "for_stratum string, " + ", ".join(f"max_{r} double" for r in RULES)
    arrow_schema(stats.sparkSession, schema)

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"for_stratum": frame["for_stratum"], **{
                f"max_{r}": [strictest(int(n), k, RULES[r][2], share, level)
                             for n, k in zip(frame["n"], frame[r])] for r in RULES}})

    return counted.mapInPandas(choose, schema)


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
             alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Statistics, ``base_failed``, broken ``rules`` and ``kept`` of every document."""
    stats = stored(statistics(docs, stratum), "rule-stats")
    chosen = stored(cutoffs(stats, labels, alpha, delta), "rule-cutoffs")
    judged = stats.join(chosen, F.col("stratum").eqNullSafe(F.col("for_stratum")), "left")
    broken = F.filter(F.array(*[F.when(rate(r) > F.col(f"max_{r}"), F.lit(r)) for r in RULES]),
                      lambda x: x.isNotNull())
    return (judged.withColumn("base_failed", base_failed()).withColumn("rules", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rules") == 0)))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verdicts(documents(spark, sf_dir, "doc_id", "text", "lang"),
                     table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "rules")
