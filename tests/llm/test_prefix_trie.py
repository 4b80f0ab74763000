"""The trie against a dictionary of prefixes; sorting and shared turns against Python's own."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import prefix_trie as p

SCHEMA = ("conv_id long, turn long, role string, text string, ids string, node binary, "
          "n_convs double, shard int")


def turn_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append(
                ((turn is not None, turn or 0, turn_key(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + ts[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below
                  if not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    len(kids), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(map(repr, out))


def got(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x", b"y", 0.5, 1) for r in rows], SCHEMA)
    return sorted(repr(tuple(r)) for r in p.trie(df, **sizes).collect())


def sample():
    rng = random.Random(7)
    rows = []
    for c in [0, 100, 101, 102, 150, 205, 233, 300, 301, 399, -5, -100, -101, *range(1000, 1060)]:
        n = rng.choice([1, 2, 3, 6, 40])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ünï", ""]))
                 for t in range(n)]
    rows += [(5000 + i, t, "user", "same") for i in range(40) for t in range(3)]
    rows += [(5100, None, None, None), (5100, None, "user", None), (5100, 0, "a", "bc"),
             (5100, 0, "ab", "c"), (5100, 0, "ab", "c"), (None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 60, "block_turns": 9}])
def test_trie_equals_dictionary(spark, sizes):
    rows = sample()
    assert got(spark, rows, **sizes) == brute(rows)


def test_single_rows_empty_table_and_one_hot_conversation(spark):
    for rows in ([], [(7, None, None, None)], [(i, 0, "u", "t") for i in range(30)]):
        assert got(spark, rows, shard_turns=8, block_turns=3) == brute(rows)


def flat(seqs):
    size = np.array([len(s) for s in seqs], dtype=np.int64)
    return np.array([x for s in seqs for x in s], dtype=np.int64), p._starts(size), size


@given(st.lists(st.lists(st.integers(0, 2), max_size=80).map(lambda s: [1] * 31 + s if len(s) > 5 else s),
                min_size=1, max_size=30))
@settings(max_examples=150, deadline=None)
def test_order_and_shared_turns(seqs):
    ids = np.arange(len(seqs))[::-1].copy()
    ranks, start, size = flat(seqs)
    order = p.lex_order(ranks, start, size, ids)
    assert order.tolist() == sorted(range(len(seqs)), key=lambda i: (seqs[i], ids[i]))
    lined = [seqs[i] for i in order]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    assert p.shared_turns(ranks, start[order], size[order]).tolist() == [
        common(a, b) for a, b in zip(lined, lined[1:])]
