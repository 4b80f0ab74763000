"""SimHash fingerprints, vantage-point search and components against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import simhash as sh
from feedrank.llm.common import documents


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [
        " ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(ids, fps, bits=3):
    fps = np.array(fps, dtype=np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= bits):
            parent[find(i)] = find(i + 1 + int(j))
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


@given(st.text(alphabet="aB \n\x1cÉé\x85 c", max_size=40))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert sh.fingerprint(text) == brute_fingerprint(text)


def test_long_text_and_spark_hash(spark):
    from pyspark.sql import functions as F
    text = "the quick Brown é"
    r = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert xxhash.xxh64_intdigest(text.encode(), 42) == r["h"] % 2 ** 64
    long = " ".join(str(i * i) for i in range(40_000))
    assert sh.fingerprint(long) == brute_fingerprint(long)


def blobs(n, seed):
    """Fingerprints in dense clusters, chains and at random."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(n // 20):
        x = rng.getrandbits(64)
        for _ in range(15):
            out.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("leaf,shard", [(4, 4), (512, 32), (16, 2)])
def test_tree_search_finds_every_pair(monkeypatch, leaf, shard):
    monkeypatch.setattr(sh, "LEAF", leaf)
    fps = np.array(blobs(600, 1), dtype=np.uint64)
    links = []
    for which in (0, 1):
        tree = sh.Tree.fit(sh.half(fps[:300], which), shard)
        i, leaf_of, home = tree.route(sh.half(fps, which), 1)
        assert home.sum() == len(fps)
        own = np.empty(len(fps), dtype=int)
        own[i[home]] = leaf_of[home]
        for k in range(tree.leaves):
            at = (leaf_of == k) & (home | (k < own[i]))
            links += list(zip(*sh.shard_links(fps[i[at]], home[at], which)))
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert int(a ^ b).bit_count() or a != b
        parent[find(int(a))] = find(int(b))
    got = [find(int(f)) for f in fps]
    exp = brute_components(list(range(len(fps))), fps)
    assert len(set(got)) == len(set(exp))
    assert len(set(zip(got, exp))) == len(set(exp))


def test_spark_components_on_clusters(spark):
    fps = blobs(300, 2)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["node"]: r["root"] for r in sh.components(
        sh.stored(sh.near_links(nodes, sample=100), "t")).collect()}
    got = [roots.get(f, f) for f in signed]
    exp = brute_components(list(range(len(fps))), fps)
    assert len(set(zip(got, exp))) == len(set(exp)) == len(set(got))


def check_components(spark, fps, **kw):
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["node"]: r["root"] for r in sh.components(sh.stored(sh.near_links(nodes, **kw), "t")).collect()}
    got, exp = [roots.get(f, f) for f in signed], brute_components(list(range(len(fps))), fps)
    assert len(set(zip(got, exp))) == len(set(exp)) == len(set(got))


def test_sample_is_constant_and_shards_follow_the_table(spark, monkeypatch):
    sizes, levels = [], []
    fit, deeper = sh.Tree.fit, sh.deeper
    monkeypatch.setattr(sh.Tree, "fit", lambda points, leaf: sizes.append(len(points)) or fit(points, leaf))
    check_components(spark, blobs(1200, 3), sample=32, shard_fps=40)
    assert sizes == [32, 32]
    points = sh.half(np.array(blobs(4000, 4), dtype=np.uint64), 0)
    start = (np.arange(len(points)), np.zeros(len(points), dtype=np.int64), np.ones(len(points), dtype=bool))
    for k in (1, 4):
        i, leaf, home = deeper(points, *start, 1, k)
        assert home.sum() == len(points) and sorted(i[home]) == list(range(len(points)))
        levels.append(np.bincount(leaf[home]).max())
    assert levels[1] < levels[0] / 3


def test_many_fingerprints_with_one_half(spark, monkeypatch):
    monkeypatch.setattr(sh, "LEAF", 50)
    rng = random.Random(9)
    fps = {(7 << 32) + rng.getrandbits(32) for _ in range(900)} | {
        (rng.getrandbits(32) << 32) + 5 for _ in range(300)}
    fps |= {f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in list(fps)[:200]}
    check_components(spark, sorted(fps), sample=64)


def test_long_chain_converges(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["root"] for r in sh.components(links).collect()} == {0}


def test_query_against_brute_force(spark, sf):
    rows = documents(spark, sf).collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in sh.op5_simhash(spark, sf).collect()}
    fps = [brute_fingerprint(r["text"]) for r in rows]
    exp = brute_components([r["doc_id"] for r in rows], fps)
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(rows, fps, exp)}


def test_odd_rows(spark, odd_docs):
    got = sorted(((r["doc_id"], r["component_id"]) for r in sh.near_duplicates(odd_docs).collect()), key=str)
    assert got.count((1, 1)) == 2 and (7, 1) in got and (2, 2) in got and (3, 2) in got and (5, 2) in got
    assert len(got) == odd_docs.count()
    kept = sh.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, None, 4, 6], key=str)
    assert sh.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1 << 27, 1 << 16])
def test_clashing_columns_and_a_full_filter(spark, monkeypatch, bits):
    """Any column names pass; a filter that knows every key leaves the result the same."""
    monkeypatch.setattr(sh, "GONE_BITS", bits)
    rows = [(i, f"t{i // 2} " * 3 + "a b c", "d", 1, "k", True, "r", 2, None) for i in range(400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, known_id int, "
                                 "known_digest string, known boolean, row string, fp int, none string")
    if bits < 1 << 20:
        monkeypatch.setattr(sh, "GONE_PROBES", 1)
    kept = sh.keep_first(docs)
    assert kept.columns == docs.columns
    found = {r["component_id"] for r in sh.near_duplicates(docs).collect()}
    got = kept.collect()
    assert len(got) == len(found) and {r["doc_id"] for r in got} == found
    assert all(tuple(r) == rows[r["doc_id"]] for r in got)


def test_one_row_of_each_component_stays(spark):
    def text(seed):
        return " ".join("".join(random.Random(f"{seed} {k}").choices("abcdefgh", k=6)) for k in range(60))

    a, b, c, d, e = map(text, "abcde")
    rows = [(3, a, "x"), (7, a, "y"), (7, b, "z"),                  # b is unique, though its id is not
            (None, c, "p"), (None, c, "q"), (None, c.upper(), "r"),   # copies without any id
            (None, d, "s"), (9, d, "t"),                              # an id goes before none
            (5, e, "u"), (5, e, "u"), (5, e + " ", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sh.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"].lower().strip()) for r in kept.collect()), key=str)
    assert got == sorted([(3, a), (7, b), (None, c), (9, d), (5, e)], key=str)
