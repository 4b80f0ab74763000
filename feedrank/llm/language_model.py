"""Operator 13: language-model scores from a log-frequency Bloom filter.

Tokens are white-space words (A-Z lower-cased) and one end per document. The
model is a bigram model with a Dirichlet prior,

    P(w | v) = (c(v w) + MU * P(w)) / (c(v) + MU),   P(w) = (c(w) + 1) / (N + V + 1),

and all its counts c come from one Bloom filter of fixed size. A count is kept as
its level, 1 + floor(log2(c / floor)): the filter holds the n-gram's levels 1 to
that one as separate members, and a reader probes level 1, 2, .. until one is
missing; the last one found stands for the middle of its range. A pair's count is
never taken for more than that of either of its words.

The filter is a set of slices, one for each group of n-gram hashes. It has
``FILTER_BYTES`` at most, whatever the corpus. Where the n-grams of a slice need
more than ``BITS`` bits each, the slice raises its ``floor`` to the least power of
two at which they fit. The n-grams below the floor are kept beside the filter with
their counts. Scoring asks the filter first; n-grams it doesn't know are looked up
there, slice by slice, and the answers go back to the documents, so no count is
lost however small the filter is. With all floors 0 there is nothing to look up.

Counting. A task adds up its n-grams and writes them as sorted, delta-coded
hashes by slice; a slice is merged in one task, and the number of slices follows
the number of tokens. Words are counted exactly, as strings, by a plain
aggregation; ``base_score`` is exact. The most frequent ``HEAD`` words travel
with the filter; all others are looked up by a join of (document row, word) pairs
with the counts, added up by row. Frequent words never meet that join. Head words
are recognised by 64-bit hashes; another word is taken for one of them with a
probability below HEAD / 2**64.

Cases: a null or empty text is one end token; repeated rows each get their row; a
null ``doc_id`` is not held out; with no training document N and V are 0 and every
word has probability 1; an empty table gives no rows; texts of any length are
scored whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, documents, narrow, per_batch, stored

FOLDS, HELD_OUT = 7, 2
MU = 8.0                # weight of the prior, in words
FILTER_BYTES = 1 << 26  # all slices together
BITS = 6                # aimed at for each member of the filter
PROBES = 3              # bits of a member
SLICE_TOKENS = 1 << 22  # tokens whose n-grams make up a slice, about
HEAD = 1 << 19          # words whose exact counts travel to the tasks
WORDS_HELD = 1 << 18    # distinct words a task remembers or adds up at a time
GRAMS_HELD = 1 << 21    # n-grams a task adds up at a time
SCORED_AT_ONCE = 1 << 18    # tokens of neighbouring documents
END = b" "              # no word has a blank
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
RESULT = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens(text: str | None) -> list[bytes]:
    """Words of a text and the end."""
    words = (text or "").encode("utf-8").lower().split()
    words.append(END)
    return words


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


# -------------------------------------------------------------------- hashes

class Hashes(dict):
    """64-bit hashes of words; forgets all when it holds ``WORDS_HELD`` of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread permutation of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def pair_hashes(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the pairs (previous word, word)."""
    return mixed(before * M1 + mixed(words + M1))


def previous(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The word before each one in documents of ``sizes`` words; their end before the first."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    ends = np.cumsum(sizes)
    before[ends - sizes] = words[ends - 1]
    return before


# ---------------------------------------------------------------- the filter

def slice_of(grams: np.ndarray, slices: int) -> np.ndarray:
    """Slice of a hash, by its upper half."""
    return ((grams >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def places(grams: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """Bit positions of (n-gram, level) within its slice."""
    h = mixed(grams + np.uint64(level * int(M1) % (1 << 64)))
    step = h * M1 | np.uint64(1)
    for k in range(PROBES):
        yield ((h + np.uint64(k) * step) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)


def fill(grams: np.ndarray, counts: np.ndarray, bits: int) -> tuple[int, np.ndarray]:
    """(log2 of the floor, bit array as bytes) of a slice's distinct n-grams."""
    tops = np.frexp(counts.astype(np.float64))[1].astype(np.int64)      # 1 + floor(log2(count))
    floor = 0
    while np.maximum(tops - floor, 0).sum() * BITS > bits:
        floor += 1
    marks = np.zeros(bits, dtype=np.uint8)
    for level in range(1, int(tops.max(initial=0)) - floor + 1):
        members = grams[tops - floor >= level]
        for at in places(members, level, bits):
            marks[at.astype(np.int64)] = 1
    return floor, np.packbits(marks, bitorder="little")


class LogFilter:
    """Slices of equal size side by side; answers estimated counts."""

    def __init__(self, marks: np.ndarray, floors: np.ndarray, bits: int):
        self.marks, self.floors, self.bits = marks, floors, bits

    def levels(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(levels of the counts, 0 where unknown; whether a count below a floor is possible)."""
        part = slice_of(grams, len(self.floors))
        start = part * self.bits
        level = np.zeros(len(grams), dtype=np.int64)
        live = np.arange(len(grams))
        while len(live):
            found = np.ones(len(live), dtype=bool)
            for at in places(grams[live], int(level[live[0]]) + 1, self.bits):
                bit = start[live] + at.astype(np.int64)
                found &= (self.marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            live = live[found]
            level[live] += 1
        floor = self.floors[part]
        return np.where(level > 0, level + floor, 0), (level == 0) & (floor > 0)

    def estimate(self, grams: np.ndarray) -> np.ndarray:
        """Counts as the levels found tell them; 0 where not even the first is there."""
        return middle(self.levels(grams)[0])


def middle(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level, 2**(level - 1) to 2**level - 1; 0 for level 0."""
    return np.where(levels > 0, (3 * np.ldexp(1.0, levels - 1) - 1) / 2, 0.0)


# ------------------------------------------------------------------ counting

def training(docs: DataFrame) -> DataFrame:
    """Narrow rows that the model learns from."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return narrow(docs).filter(F.coalesce(fold != HELD_OUT, F.lit(True)))


def word_counts(train: DataFrame) -> DataFrame:
    """``word`` (binary) and its exact count ``n``."""
    target = arrow_schema(train.sparkSession, "word binary, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
                schema=target)
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) >= WORDS_HELD:
                    yield out()
        yield out()

    part = train.select("text").mapInArrow(run, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def packed(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes as deltas of equal width, then their counts less 1 (escape: 255)."""
    delta = np.diff(grams, prepend=np.uint64(0))
    width = max(1, -(-int(delta[1:].max(initial=0)).bit_length() // 8))
    low = delta.astype("<u8").view(np.uint8).reshape(-1, 8)[1:, :width]
    large = counts > 255
    return b"".join((np.array([len(grams), width], "<u4").tobytes(), grams[:1].astype("<u8").tobytes(),
                     low.tobytes(), np.where(large, 255, counts - 1).astype(np.uint8).tobytes(),
                     counts[large].astype("<u8").tobytes()))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width = np.frombuffer(blob, "<u4", 2).tolist()
    delta = np.zeros((n, 8), dtype=np.uint8)
    delta[0] = np.frombuffer(blob, np.uint8, 8, 8)
    end = 16 + (n - 1) * width
    delta[1:, :width] = np.frombuffer(blob, np.uint8, (n - 1) * width, 16).reshape(n - 1, width)
    counts = np.frombuffer(blob, np.uint8, n, end).astype(np.int64) + 1
    large = counts == 256
    counts[large] = np.frombuffer(blob, "<u8", int(large.sum()), end + n).astype(np.int64)
    return np.cumsum(delta.view("<u8").ravel(), dtype=np.uint64), counts


def added(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, counts added up."""
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))[:len(grams)]
    return grams[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def build_filter(train: DataFrame, n_tokens: int, filter_bytes: int = FILTER_BYTES,
                 slice_tokens: int = SLICE_TOKENS) -> tuple[LogFilter, DataFrame]:
    """The filter over all words and pairs of ``train``, which has ``n_tokens`` tokens.

    And ``slice``, ``rest``: the packed n-grams of a slice that lie below its floor.
    """
    spark = train.sparkSession
    slices = int(min(n_tokens // slice_tokens + 1, filter_bytes // 64))
    bits = min(filter_bytes // slices // 8 * 64, slice_tokens * BITS)
    bits -= bits % 8
    schema = "slice int, blob binary"
    target = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            grams = np.concatenate(held)
            grams, counts = added(grams, np.ones(len(grams), dtype=np.int64))
            part = slice_of(grams, slices)
            cut = np.flatnonzero(np.diff(part)) + 1
            rows = [(int(p[0]), packed(g, c)) for p, g, c in zip(
                np.split(part, cut), np.split(grams, cut), np.split(counts, cut))]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary())], schema=target)

        for batch in batches:
            for text in batch.column(0):
                words = memo.of(tokens(text.as_py()))
                before = previous(words, np.array([len(words)]))
                held += [mixed(words), pair_hashes(before, words)]
                size += 2 * len(words)
                if size >= GRAMS_HELD:
                    yield out()
                    size = 0
        if held:
            yield out()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        grams, counts = (np.concatenate(x) for x in zip(*map(unpacked, group["blob"])))
        grams, counts = added(grams, counts)
        floor, marks = fill(grams, counts, bits)
        low = counts < 1 << floor
        return pd.DataFrame({"slice": [int(group["slice"].iloc[0])], "floor": [floor],
                             "marks": [marks.tobytes()],
                             "rest": [packed(grams[low], counts[low]) if low.any() else None]})

    built = stored(train.select("text").mapInArrow(run, schema).groupBy("slice")
                   .applyInPandas(merge, "slice int, floor int, marks binary, rest binary"), "lm-filter")
    rows = built.select("slice", "floor", "marks").collect()            # filter_bytes at most
    marks, floors = np.zeros(slices * bits // 8, dtype=np.uint8), np.zeros(slices, dtype=np.int64)
    for r in rows:
        at = r["slice"] * bits // 8
        marks[at:at + bits // 8] = np.frombuffer(r["marks"], np.uint8)
        floors[r["slice"]] = r["floor"]
    return LogFilter(marks, floors, bits), built.filter("rest IS NOT NULL").select("slice", "rest")


# ------------------------------------------------------------------- scoring

def token_logs(single: np.ndarray, behind: np.ndarray, both: np.ndarray, n: int, v: int,
               mu: float = MU) -> np.ndarray:
    """log10 P(w | v) from the levels of w, v and v w."""
    single, behind, both = middle(single), middle(behind), middle(both)
    prior = np.minimum((single + 1) / (n + v + 1), 1.0)
    return np.log10((np.minimum(both, np.minimum(single, behind)) + mu * prior) / (behind + mu))


class Late:
    """Tokens of a batch whose probability needs n-grams that the filter doesn't know.

    ``asked``: those n-grams, in order. ``codes``: for each token the levels of w, v
    and v w, a place in ``asked`` as -1 - place. ``docs``, ``counts``: numbers of such
    tokens by document of the batch.
    """

    def __init__(self, asked: np.ndarray, codes: np.ndarray, docs: np.ndarray, counts: np.ndarray):
        self.asked, self.codes, self.docs, self.counts = asked, codes, docs, counts

    def asks(self, slices: int) -> tuple[list[int], list[bytes]]:
        """Slices and their part of ``asked``; a later slice has larger hashes."""
        part = slice_of(self.asked, slices)
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        return part[cut].tolist(), [x.astype("<u8").tobytes() for x in np.split(self.asked, cut[1:])]

    def state(self, numbers: list[int]) -> bytes:
        """Codes and documents; ``numbers``: the rows of the batch's documents."""
        rows = np.array(numbers, dtype="<i8")[self.docs]
        return b"".join((np.array([len(rows)], "<i8").tobytes(), rows.tobytes(),
                         self.counts.astype("<i8").tobytes(), self.codes.astype("<i4").tobytes()))


def late_logs(state: bytes, levels: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their log10 still missing) from a state and the levels of the n-grams asked."""
    size = int(np.frombuffer(state, "<i8", 1)[0])
    rows, counts = np.frombuffer(state, "<i8", 2 * size, 8).reshape(2, size)
    codes = np.frombuffer(state, "<i4", -1, 8 + 16 * size).astype(np.int64).reshape(3, -1)
    found = np.where(codes < 0, levels[np.maximum(-1 - codes, 0)], codes)
    return rows, np.add.reduceat(token_logs(*found, n, v), np.cumsum(counts) - counts)


def log_probabilities(model: LogFilter, words: np.ndarray, sizes: np.ndarray, n: int,
                      v: int) -> tuple[np.ndarray, Late | None]:
    """log10 of the probability of each document, ``sizes`` word hashes one after another.

    Without the tokens that are returned as :class:`Late`.
    """
    grams, at = np.unique(mixed(words), return_inverse=True)
    pairs, both_at = np.unique(pair_hashes(previous(words, sizes), words), return_inverse=True)
    single, single_open = model.levels(grams)
    both, both_open = model.levels(pairs)
    if single_open.any() or both_open.any():
        asked = np.unique(np.concatenate([grams[single_open], pairs[both_open]]))
        single[single_open] = -1 - np.searchsorted(asked, grams[single_open])
        both[both_open] = -1 - np.searchsorted(asked, pairs[both_open])
    single, both = single[at], both[both_at]
    codes = np.stack([single, previous(single, sizes), both])
    first = np.cumsum(sizes) - sizes
    wait = (codes < 0).any(axis=0)
    if not wait.any():
        return np.add.reduceat(token_logs(*codes, n, v), first), None
    logs = np.where(wait, 0.0, token_logs(*np.maximum(codes, 0), n, v))
    counts = np.add.reduceat(wait.astype(np.int64), first)
    docs = np.flatnonzero(counts)
    return np.add.reduceat(logs, first), Late(asked, codes[:, wait], docs, counts[docs])


def looked_up(asks: DataFrame, rest: DataFrame) -> DataFrame:
    """Levels of the n-grams of ``asks`` (batch, slice, grams), one byte each."""
    def answer(asked: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
        grams, counts = unpacked(below["rest"].iloc[0]) if len(below) else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        tops = np.append(np.frexp(counts.astype(np.float64))[1], 0).astype(np.uint8)

        def levels(blob: bytes) -> bytes:
            wanted = np.frombuffer(blob, "<u8")
            at = np.searchsorted(grams, wanted)
            there = np.append(grams, np.uint64(0))[at] == wanted
            return np.where(there, tops[at], 0).astype(np.uint8).tobytes()

        return pd.DataFrame({"batch": asked["batch"], "slice": asked["slice"],
                             "levels": [levels(x) for x in asked["grams"]]})

    return asks.groupBy("slice").cogroup(rest.groupBy("slice")).applyInPandas(
        answer, "batch long, slice int, levels binary")


def late_scores(part: DataFrame, rest: DataFrame, n: int, v: int) -> DataFrame:
    """``row`` and ``late``, the log10 of its tokens that waited for the look-up."""
    asks = (part.filter("late IS NOT NULL")
            .select(F.col("number").alias("batch"), F.explode(F.arrays_zip("slices", "grams")).alias("r"))
            .select("batch", F.col("r.slices").alias("slice"), F.col("r.grams").alias("grams")))
    states = part.filter("late IS NOT NULL").select(F.col("number").alias("batch"), "late")

    def finish(state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        levels = np.frombuffer(b"".join(answers.sort_values("slice")["levels"]), np.uint8)
        rows, logs = late_logs(state["late"].iloc[0], levels.astype(np.int64), n, v)
        return pd.DataFrame({"row": rows, "late": logs})

    return states.groupBy("batch").cogroup(looked_up(asks, rest).groupBy("batch")).applyInPandas(
        finish, "row long, late double")


def head_of(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order and counts of the most frequent words, ``size`` at most.

    All words from some count on, by a histogram over eighths of powers of two;
    words whose hash another head word has too are left to the join.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    least, seen = 1 << 20, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(),   # 8 * 64 rows at most
                    key=lambda r: -r["step"]):
        seen += r["count"]
        if seen > size:
            break
        least = r["step"]
    target = arrow_schema(counts.sparkSession, "words binary, n binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [xxhash.xxh3_64_intdigest(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.array(hashes, dtype="<u8").tobytes()], pa.binary()),
                 pa.array([batch.column(1).to_numpy().astype("<i8").tobytes()], pa.binary())],
                schema=target)

    rows = (counts.filter(step >= least).select("word", "n")
            .mapInArrow(run, "words binary, n binary").collect())           # 16 bytes a head word
    hashes = np.frombuffer(b"".join(r["words"] for r in rows), dtype="<u8")
    keys, first, times = np.unique(hashes, return_index=True, return_counts=True)
    n = np.frombuffer(b"".join(r["n"] for r in rows), dtype="<i8")[first]
    return keys[times == 1], n[times == 1]


def score(docs: DataFrame, filter_bytes: int = FILTER_BYTES, slice_tokens: int = SLICE_TOKENS,
          head: int = HEAD) -> DataFrame:
    """``RESULT`` for every document."""
    spark = docs.sparkSession
    train = training(docs)
    counts = stored(word_counts(train), "lm-words")
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    share = spark.sparkContext.broadcast
    built, below = build_filter(train, n, filter_bytes, slice_tokens)
    model, slices, lossy = share(built), len(built.floors), bool(built.floors.any())
    top = share(head_of(counts, head))

    def rows(batch: Iterator[tuple]) -> Iterator[tuple]:
        memo = Hashes()
        none = (None, None, None)
        keys, known = top.value
        held: list[tuple[int, int, list[bytes]]] = []
        size = 0

        def out() -> Iterator[tuple]:
            hashes = memo.of([w for _, _, words in held for w in words])
            sizes = np.array([len(words) for _, _, words in held])
            first = np.cumsum(sizes) - sizes
            at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
            there = keys[at] == hashes if len(keys) else np.zeros(len(hashes), dtype=bool)
            logs = np.where(there, np.log10(known[at] + 1), 0.0) if len(keys) else np.zeros(len(hashes))
            scores, late = log_probabilities(model.value, hashes, sizes, n, v)
            # the batch's first row carries what waits
            waits = (late.state([number for number, _, _ in held]), *late.asks(slices)) if late else none
            numbers = (x.tolist() for x in (
                sizes, np.add.reduceat(there.astype(np.int64), first), np.add.reduceat(logs, first),
                scores, first))
            for (number, doc_id, words), m, heads, log, p, k in zip(held, *numbers):
                rest = Counter(words[i] for i in np.flatnonzero(~there[k:k + m]).tolist())
                yield (number, doc_id, is_held_out(doc_id), m, heads, log, p,
                       list(rest), list(rest.values()), *waits)
                waits = none
            held.clear()

        for number, doc_id, text in batch:
            held.append((number, doc_id, tokens(text)))
            size += len(held[-1][2])
            if size >= SCORED_AT_ONCE:
                yield from out()
                size = 0
        if held:
            yield from out()

    numbered = narrow(docs).select(F.monotonically_increasing_id().alias("number"), "doc_id", "text")
    part = stored(per_batch(
        numbered, "number long, doc_id long, held_out boolean, n_tokens long, n_head long, "
        "head_log double, score double, words array<binary>, times array<long>, "
        "late binary, slices array<int>, grams array<binary>", rows), "lm-rows")
    pairs = (part.select(F.col("number").alias("row"), F.explode(F.arrays_zip("words", "times")).alias("r"))
             .select("row", F.col("r.words").alias("token"), F.col("r.times").alias("times")))
    rest = (pairs.join(counts, pairs["token"] == counts["word"])
            .groupBy("row").agg(F.sum("times").alias("n_rest"),
                                F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_log")))
    base = (F.col("head_log") + F.coalesce("rest_log", F.lit(0.0))
            - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1))))
    out = part.drop("words", "times", "late", "slices", "grams").join(
        rest, part["number"] == rest["row"], "left").drop("row")
    whole = F.col("score")
    if lossy:
        late = late_scores(part, below, n, v)
        out = out.join(late, out["number"] == late["row"], "left")
        whole = whole + F.coalesce("late", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), whole.alias("score"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir, "doc_id", "text"))
