"""Operator 2: benchmark decontamination by local alignment.

Both sides are word sequences (runs of letters, digits and underscores, lower
case). A document holds an item if their Smith-Waterman score (+2 match, -1
mismatch, -1 gap), divided by the item's best possible one, reaches the
threshold.

Seeds. A score that reaches the threshold matches at least that share of the
item's positions. An item's most frequent words that cover up to half of that
share are left out; all its other words are its seeds (1-grams; longer ones miss
copies with a word put in after each one), and a match holds at least the share
less what was left out of them. How frequent a word is, is counted by items of the
test set: copies in the corpus, however many, don't change the seeds. A document
meets an item through an index from seeds to items; items of whose seeds it
doesn't hold that many are never looked at.

Three upper bounds of the score then pick the pairs and windows to align. None
of them drops a pair that reaches the threshold:

1. reach: the item positions whose word the document holds count +2;
2. along the item: the best run of positions, +2 for a word the document holds
   and -1 for another, as an item word without a match costs at least 1;
3. along the document: the same over its words. A best alignment never falls to
   zero on its way, so it lies within one stretch in which that running sum
   stays above zero. These stretches are the windows; each must pass bound 2 by
   itself before it is aligned.

The test set is held in blocks of at most ``BLOCK_WORDS`` words, broadcast and
released one after another; each block is one pass over the documents.

Cases: null or empty texts and items match nothing; repeated rows of documents
each give their rows; an item id with several rows reports its best one; of equal
scores the first window counts; texts of any length are aligned window by window;
an empty table or test set gives no matches.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, documents, forget, per_document, stored, table

WORD = re.compile(r"\w+")
THRESHOLD = 0.4         # unrelated texts stay below 0.35
BLOCK_WORDS = 200_000
MATCH, MISMATCH, GAP = 2, -1, -1
RESULT = "doc_id long, item_id long, score double, start long, end long"


class Index:
    """One block of the test set: words, items as word ids, item positions by word."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.words: dict[str, int] = {}
        self.item_ids: list[int | None] = []
        self.items: list[np.ndarray] = []
        for item_id, text in rows:
            seq = [self.words.setdefault(w, len(self.words))
                   for w in WORD.findall((text or "").lower())]
            if seq:
                self.item_ids.append(item_id)
                self.items.append(np.array(seq, dtype=np.int64))
        self.apart = [np.concatenate([[-1], s]) for s in self.items]
        self.full = MATCH * np.array([len(s) for s in self.items], dtype=np.int64)
        self.holders = np.bincount(
            np.concatenate([*map(np.unique, self.items), np.zeros(0, dtype=np.int64)]),
            minlength=len(self.words))          # items that hold a word
        self.seeded: dict[float, tuple[np.ndarray, np.ndarray]] = {}
        self.here = np.zeros(len(self.words) + 1, dtype=bool)   # the last place: unknown words

    def sequence(self, text: str) -> np.ndarray:
        """Word ids of a text, -1 for words that no item holds."""
        found = WORD.findall(text.lower())
        return np.fromiter(map(self.words.get, found, repeat(-1)), dtype=np.int64,
                           count=len(found))

    def by_seed(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items by seed word, where each word's items begin, and seeds that a match holds at least."""
        if threshold not in self.seeded:
            seeds, least = zip(*[seeds_of(s, self.holders, threshold) for s in self.items]) \
                if self.items else ((), ())
            flat = np.concatenate([*seeds, np.zeros(0, dtype=np.int64)])
            owner = np.repeat(np.arange(len(self.items)), [len(s) for s in seeds])
            order = np.argsort(flat, kind="stable")
            self.seeded[threshold] = (
                owner[order], np.searchsorted(flat[order], np.arange(len(self.words) + 1)),
                np.array(least, dtype=np.int64))
        return self.seeded[threshold]

    def reached(self, held: np.ndarray, threshold: float) -> np.ndarray:
        """Items met through a seed that pass bounds 1 and 2; ``held`` marks the document's words."""
        on = held[:-1].nonzero()[0]
        owner, first, least = self.by_seed(threshold)
        lo, size = first[on], first[on + 1] - first[on]
        pick = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        some = (np.bincount(owner[pick], minlength=len(self.items)) >= least).nonzero()[0]
        if not len(some):
            return some
        met = [self.items[i] for i in some.tolist()]
        begin = np.cumsum([0, *map(len, met)])[:-1]
        reach = MATCH * np.add.reduceat(held[np.concatenate(met)].astype(np.int64), begin)
        some = some[reach >= threshold * self.full[some]]
        if not len(some):
            return some
        # the items side by side, each after a step that takes the sum to zero
        part = [self.apart[i] for i in some.tolist()]
        first = np.cumsum([0, *map(len, part)])[:-1]
        step = np.where(held[np.concatenate(part)], MATCH, -1)
        step[first] = -int(self.full.max())
        return some[np.maximum.reduceat(running(step), first) >= threshold * self.full[some]]

    def among(self, seq: np.ndarray, known: np.ndarray) -> np.ndarray:
        """+2 where ``known`` holds the word of ``seq``, -1 elsewhere."""
        self.here[known] = True
        self.here[-1] = False
        step = np.where(self.here[seq], MATCH, -1)
        self.here[known] = False
        return step

    def windows(self, item: np.ndarray, seq: np.ndarray, least: float) -> list[tuple[int, int]]:
        """Stretches of a document in which an alignment can score ``least``."""
        above = running(self.among(seq, item))
        if above.max() < least:
            return []
        edge = np.diff(above > 0, prepend=False, append=False).nonzero()[0]
        return [(start, end) for start, end in edge.reshape(-1, 2).tolist()
                if above[start:end].max() >= least
                and running(self.among(item, seq[start:end])).max() >= least]


def seeds_of(item: np.ndarray, holders: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """Seeds of an item, once for each position, and how many of them a match holds at least."""
    words, times = np.unique(item, return_counts=True)
    order = np.argsort(-holders[words], kind="stable")          # the most frequent first
    covered = np.cumsum(times[order])
    needed = max(1, int(np.ceil(threshold * len(item) - 1e-9)))     # positions a match covers
    left_out = covered <= needed // 2
    seeds = np.repeat(words[order], np.where(left_out, 0, times[order]))
    return seeds, needed - int(covered[left_out].max(initial=0))


def running(step: np.ndarray) -> np.ndarray:
    """Running sum that stops at zero."""
    total = np.cumsum(step)
    return total - np.minimum(np.minimum.accumulate(total), 0)


def align(item: np.ndarray, doc: np.ndarray) -> tuple[int, int]:
    """Best local alignment: (score, end in doc, exclusive)."""
    ramp = np.arange(1, len(doc) + 1) * -GAP
    row = np.zeros(len(doc) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item.tolist():
        diagonal = row[:-1] + np.where(doc == w, MATCH, MISMATCH)
        cell = np.maximum(np.maximum(diagonal, row[1:] + GAP), 0)
        cell = np.maximum(cell, np.maximum.accumulate(cell + ramp) - ramp)
        row[1:] = cell
        top = int(cell.argmax())
        if cell[top] > best:
            best, end = int(cell[top]), top + 1
    return best, end


def matches(index: Index, seq: np.ndarray, threshold: float = THRESHOLD) -> list[tuple]:
    """(item_id, score, start, end) of the items found in a word sequence."""
    best: dict[int | None, tuple[float, int, int]] = {}
    held = np.zeros(len(index.words) + 1, dtype=bool)
    held[seq] = True
    held[-1] = False
    for number in index.reached(held, threshold).tolist():
        item, full, item_id = index.items[number], int(index.full[number]), index.item_ids[number]
        for start, end in index.windows(item, seq, threshold * full):
            doc = seq[start:end]
            score, stop = align(item, doc)
            if score < threshold * full or score / full <= best.get(item_id, (0,))[0]:
                continue
            back = align(item[::-1], doc[:stop][::-1])[1]
            best[item_id] = (score / full, start + stop - back, start + stop)
    return [(item_id, *found) for item_id, found in best.items()]


# --------------------------------------------------------------------- Spark

def blocks(items: DataFrame, words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """The test set in blocks of about ``words`` words, one collected at a time."""
    slim = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("string").alias("text"))
    total = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // (words * 4) + 1                # an average word takes over four signs
    for k in range(n):
        part = slim.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item found in it; ``start``, ``end`` count words."""
    parts: list[DataFrame] = []
    for block in blocks(items, words):
        index = docs.sparkSession.sparkContext.broadcast(Index(block))

        def rows(pairs: Iterator[tuple], index=index) -> Iterator[tuple]:
            for doc_id, text in pairs:
                for found in matches(index.value, index.value.sequence(text or ""), threshold):
                    yield doc_id, *found

        parts.append(stored(per_document(docs, RESULT, rows), "decontaminate-found"))
        index.destroy()
    return functools.reduce(DataFrame.union, parts)


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
               words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no test item is found."""
    arrow_schema(docs.sparkSession, RESULT)                     # ships the package
    at = docs.columns.index("text")

    def cleaned(df: DataFrame, index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not matches(index.value, index.value.sequence(t.as_py() or ""), threshold)
                         for t in batch.column(at)]
                yield batch.filter(pa.array(clean, type=pa.bool_()))

        return df.mapInArrow(run, docs.schema)

    read, index, out = docs, None, docs
    for block in blocks(items, words):
        if index is not None:                   # the last block's pass ends before the next begins
            left = stored(out, "decontaminate-clean")
            index.destroy()
            if read is not docs:
                forget(read)
            read = left
        index = docs.sparkSession.sparkContext.broadcast(Index(block))
        out = cleaned(read, index)
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir, "doc_id", "text"),
                        table(spark, sf_dir, "benchmark"))
