"""Base scores against exact counts; the filter against its counts; model against plain Python."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import language_model as m
from feedrank.llm.common import documents


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    count = Counter(w for i, t in rows if not held(i) for w in words_of(t))
    n, v = sum(count.values()), len(count)
    return sorted((repr(i), held(i), len(words_of(t)), sum(count[w] > 0 for w in words_of(t)), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words_of(t)), 6))
                  for i, t in rows)


def check(spark, df, **sizes):
    out = m.score(df, **sizes).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                  round(r["base_score"], 6)) for r in out)
    assert got == brute(rows)
    return out


def test_odd_rows(spark, odd_docs):
    more = odd_docs.selectExpr("*", "1 AS number", "text AS word", "2 AS n", "3 AS score_", "4 AS row")
    for sizes in ({}, {"head": 3, "slice_tokens": 1000}, {"head": 0}):
        out = check(spark, more, **sizes)
        assert all(r["score"] <= 0 for r in out)


def test_empty_and_untrained_tables(spark, odd_docs):
    assert m.score(odd_docs.limit(0)).collect() == []
    only = next(i for i in range(100) if held(i))
    out = m.score(spark.createDataFrame([(only, "a b a")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in out] == [(only, True, 4, 0, 0, 0.0, 0.0)]


def test_corpus_and_held_out_gain(spark):
    df = documents(spark, "/root/testdata/sf0.01", "doc_id", "text")
    out = check(spark, df, head=500)
    gain = [(r["score"] - r["base_score"]) / r["n_tokens"] for r in out if r["held_out"] and r["n_tokens"] > 50]
    assert len(gain) > 50 and np.mean(gain) > 0.05      # log10 a token, on unseen documents


def test_model_against_plain_counts(spark):
    """With a roomy filter and counts of 1 and 2 levels, scores follow the formula."""
    rows = [(i, t) for i, t in enumerate(["a b c d", "a b x y", "q r s", "a b", "u v w"] * 3)]
    train = [words_of(t) for i, t in rows if not held(i)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([None, *t[:-1]], t))

    def mid(c):
        return (3 * (1 << (c.bit_length() - 1)) - 1) / 2 if c else 0.0

    n, v = sum(one.values()), len(one)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in m.score(df).collect():
        t, want = words_of(rows[r["doc_id"]][1]), 0.0
        for a, b in zip([None, *t[:-1]], t):
            both = min(mid(two[a, b]), mid(one[a]), mid(one[b]))
            want += math.log10((both + m.MU * min(1, (mid(one[b]) + 1) / (n + v + 1))) / (mid(one[a]) + m.MU))
        assert r["score"] == pytest.approx(want, abs=1e-9)


def test_counts_below_the_floor_are_looked_up(spark):
    """A filter too small for the rare n-grams scores as a roomy one does, but for false positives."""
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 400}" for k in range(30)) + (" often seen" * 60))
            for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {r["doc_id"]: r["score"] for r in m.score(df).collect()}
    n = sum(len(words_of(t)) for i, t in rows if not held(i))
    built, below = m.build_filter(m.training(df), n, 1 << 10, 3000)
    assert built.floors.min() > 0 and below.count() == len(built.floors)
    got = {r["doc_id"]: r["score"] for r in m.score(df, filter_bytes=1 << 10, slice_tokens=3000).collect()}
    off = [abs(got[i] - want[i]) / len(words_of(t)) for i, t in rows]
    assert len(got) == len(rows) and np.mean(off) < 0.02


@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 10**6), min_size=1, max_size=300),
       st.sampled_from([1, 3, 7]))
@settings(max_examples=60, deadline=None)
def test_filter_never_underestimates(counts, slices):
    bits = 4096
    grams = np.array(sorted(counts), dtype=np.uint64)
    n = np.array([counts[g] for g in grams.tolist()], dtype=np.int64)
    part = m.slice_of(grams, slices)
    floors, marks = np.zeros(slices, dtype=np.int64), np.zeros(slices * bits // 8, dtype=np.uint8)
    for s in range(slices):
        floors[s], own = m.fill(grams[part == s], n[part == s], bits)
        marks[s * bits // 8:(s + 1) * bits // 8] = own
    found = m.LogFilter(marks, floors, bits).estimate(grams)
    low = 2.0 ** np.floor(np.log2(n))
    kept = n >= 2 ** floors[part]
    assert (found[kept] >= ((3 * low - 1) / 2)[kept]).all()


@given(st.dictionaries(st.integers(0, 2**64 - 1), st.sampled_from([1, 2, 255, 256, 10**9]),
                       min_size=1, max_size=50))
@settings(max_examples=100, deadline=None)
def test_packing_round_trip(counts):
    grams = np.array(sorted(counts), dtype=np.uint64)
    n = np.array([counts[g] for g in grams.tolist()], dtype=np.int64)
    back = m.unpacked(m.packed(grams, n))
    assert (back[0] == grams).all() and (back[1] == n).all()


def test_false_positive_rate_at_the_aimed_load():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64))
    bits = len(grams) * m.BITS // 8 * 8 + 8
    floor, marks = m.fill(grams, np.ones(len(grams), dtype=np.int64), bits)
    other = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    found = m.LogFilter(marks, np.array([floor]), bits).estimate(other)
    assert floor == 0 and (found > 0).mean() < 0.08
