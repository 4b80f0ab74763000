"""Operator 5: SimHash near-duplicates, linked through vantage-point trees.

Fingerprints: 64-bit SimHash over word shingles. Equal fingerprints are one
node; nodes link when they differ in at most ``MAX_BITS`` bits.

Search. Distances between 64-bit fingerprints crowd around 32, so a tree over
whole fingerprints prunes little at radius 3. Each fingerprint is therefore
searched by its two 32-bit halves: fingerprints within 3 bits have a half within
1 bit (3 // 2), and Hamming distance on a half is a metric that never exceeds
the whole one. For each half a vantage-point tree is fitted to ``SAMPLE``
fingerprints, the first in hash order, whatever the size of the table. An inner
node holds a vantage point v and a radius r and sends x left if d(v, x) <= r.
Below the fitted leaves the tree goes on with vantage points that follow from the
node's number, half the width as radius, for as many levels as give a shard about
``SHARD_FPS`` distinct fingerprints. Every fingerprint has one home shard; by the
triangle bound it also visits the other side of a node when |d(v, x) - r| allows a
neighbour there, so shards whose boundary it overlaps see it too. A pair from two
shards is compared in the one with the smaller number. Within its task a shard
fits the same kind of tree to its own fingerprints down to small leaves, where all
64 bits are compared exactly: every pair within the distance is found, whatever
the sample was. Fingerprints that no vantage point parts, as they share a half,
are compared by the bytes of the other half: of four bytes one is equal.

A shard emits a spanning forest of its links, at most one row for each
fingerprint it read, never all pairs of a dense group. Components are found by
minimum labels with pointer jumping over tables in the shared folder.

Cases: null or empty texts have fingerprint zero and link like any other;
repeated rows each get their row; a null ``doc_id`` never names a component
unless all of its documents lack an id (then null); empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, documents, forget, per_batch, per_document, stored

SHINGLE = 3             # words
SEED = 42
MAX_BITS = 3
SAMPLE = 8192           # fingerprints that fit the top of the trees
SHARD_FPS = 1 << 16     # aimed at as home fingerprints of a shard
SHARD = 32              # sample points in a fitted leaf
GONE_BITS = 1 << 27     # of the filter over keys that may have to go
GONE_PROBES = 3
LEAF = 512              # fingerprints in a leaf compared exhaustively
HALF_RADIUS = MAX_BITS // 2
ROUTED = "tree int, shard long, fp long, home boolean"


# -------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *ends]
        hashes = [digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends[size - 1:])]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[k:k + (1 << 14)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def signed(fp: int) -> int:
    """The bits of an unsigned 64-bit integer as a signed one."""
    return fp - (1 << 64) if fp >> 63 else fp


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long)."""

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in pairs:
            yield doc_id, signed(fingerprint(text, size))

    return per_document(docs, "doc_id long, fp long", rows)


# ---------------------------------------------------------------------- tree

@dataclass
class Tree:
    """Vantage-point tree over 32-bit values, as arrays of nodes.

    Node i sends x to ``left[i]`` if d(vantage[i], x) <= radius[i], else to
    ``right[i]``; a child c < 0 is the leaf -c - 1.
    """

    vantage: list[int] = field(default_factory=list)
    radius: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaves: int = 0
    root: int = -1

    @classmethod
    def fit(cls, points: np.ndarray, leaf: int) -> "Tree":
        tree = cls()
        tree.root = tree._grow(np.asarray(points, dtype=np.uint32), leaf)
        return tree

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        if len(points) > leaf:
            v = points[len(points) // 2]
            d = np.bitwise_count(points ^ v).astype(np.int64)
            below = np.cumsum(np.bincount(d, minlength=33))
            r = int(np.abs(below[:-1] - len(points) / 2).argmin())
            if 0 < below[r] < len(points):
                node = len(self.vantage)
                self.vantage.append(int(v))
                self.radius.append(r)
                self.left.append(0)
                self.right.append(0)
                self.left[node] = self._grow(points[d <= r], leaf)
                self.right[node] = self._grow(points[d > r], leaf)
                return node
        self.leaves += 1
        return -self.leaves

    def route(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of point, leaf, is home) for each leaf a ball of ``reach`` meets."""
        index, home = np.arange(len(points)), np.ones(len(points), dtype=bool)
        at = np.full(len(points), self.root)
        vantage = np.array(self.vantage or [0], dtype=np.uint32)
        radius = np.array(self.radius or [0])
        left, right = np.array(self.left or [0]), np.array(self.right or [0])
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(index):
            out = at < 0
            done.append((index[out], -at[out] - 1, home[out]))
            index, at, home = index[~out], at[~out], home[~out]
            d = np.bitwise_count(points[index] ^ vantage[at]).astype(np.int64)
            r = radius[at]
            goes_left = d <= r
            also = np.where(goes_left, d + reach > r, d - reach <= r)
            near = np.where(goes_left, left[at], right[at])
            far = np.where(goes_left, right[at], left[at])
            index, at, home = (np.concatenate([index, index[also]]),
                               np.concatenate([near, far[also]]),
                               np.concatenate([home, np.zeros(int(also.sum()), dtype=bool)]))
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (index, at, home)


def deeper(points: np.ndarray, index: np.ndarray, leaf: np.ndarray, home: np.ndarray, reach: int,
           levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Carries a route on below the leaves; a leaf's two halves are 2 leaf and 2 leaf + 1."""
    for level in range(levels):
        vantage = _scattered(leaf + (level << 48))
        d = np.bitwise_count(points[index] ^ vantage).astype(np.int64)
        left = d <= 16
        also = np.where(left, d + reach > 16, d - reach <= 16)
        near = 2 * leaf + ~left
        index, leaf, home = (np.concatenate([index, index[also]]),
                             np.concatenate([near, near[also] ^ 1]),
                             np.concatenate([home, np.zeros(int(also.sum()), dtype=bool)]))
    return index, leaf, home


def _scattered(numbers: np.ndarray) -> np.ndarray:
    """A well-spread 32-bit value for each node number."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def half(fps: np.ndarray, which: int) -> np.ndarray:
    return (fps >> np.uint64(32 * which)).astype(np.uint32)


# --------------------------------------------------------------------- links

class _Forest:
    """Union-find over positions 0..n-1 with array labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            on = x != y
            if not on.any():
                return
            a, b = a[on], b[on]
            low, high = np.minimum(x[on], y[on]), np.maximum(x[on], y[on])
            np.minimum.at(self.label, high, low)          # hook larger roots
            while True:                                   # then flatten
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def shard_links(fps: np.ndarray, home: np.ndarray, which: int,
                max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between home fingerprints and all of a shard."""
    owners = np.flatnonzero(home)
    forest = _Forest(len(fps))
    if len(owners):
        points = half(fps, which)
        tree = Tree.fit(points[owners], LEAF)
        at_home = tree.route(points[owners], 0)
        asked = tree.route(points, max_bits // 2)
        members = _by_leaf(owners[at_home[0]], at_home[1])
        queries = _by_leaf(asked[0], asked[1])
        for leaf, inside in members.items():
            ask = queries[leaf]
            if len(inside) <= LEAF or max_bits > 3:
                _compare(fps, ask, inside, max_bits, forest)
                continue
            for shift in range(32 * (1 - which), 32 * (1 - which) + 32, 8):   # one byte is equal
                members_of, asked_of = (
                    _by_leaf(x, fps[x] >> np.uint64(shift) & np.uint64(255)) for x in (inside, ask))
                for byte, part in members_of.items():
                    _compare(fps, asked_of[byte], part, max_bits, forest)
    child = np.flatnonzero(forest.label != np.arange(len(fps)))
    return fps[child], fps[forest.label[child]]


def _compare(fps: np.ndarray, ask: np.ndarray, inside: np.ndarray, max_bits: int,
             forest: _Forest) -> None:
    """Links every ``ask`` with every ``inside`` within the distance, in steps."""
    step = max(1, (1 << 20) // len(inside))
    for k in range(0, len(ask), step):
        q = ask[k:k + step]
        near = np.bitwise_count(fps[q][:, None] ^ fps[inside][None, :]) <= max_bits
        i, j = np.nonzero(near)
        forest.add(q[i], inside[j])


def _by_leaf(items: np.ndarray, leaf: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(leaf, kind="stable")
    keys, first = np.unique(leaf[order], return_index=True)
    return dict(zip(keys.tolist(), np.split(items[order], first[1:])))


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE,
               shard_fps: int = SHARD_FPS) -> DataFrame:
    """Links (a, b) that connect all ``fp`` of ``nodes`` within ``max_bits``.

    ``nodes`` has distinct values. The links span the same components as the
    full graph of near pairs.
    """
    spark = nodes.sparkSession
    picked = [r["fp"] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    points = np.array(picked, dtype=np.int64).view(np.uint64)
    trees = [Tree.fit(half(points, w), SHARD) for w in (0, 1)]
    shards = -(-nodes.count() // shard_fps)
    levels = [max(0, (-(-shards // t.leaves) - 1).bit_length()) for t in trees]
    target = arrow_schema(spark, ROUTED)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for which, tree in enumerate(trees):
                values = half(fps.view(np.uint64), which)
                i, leaf, home = deeper(values, *tree.route(values, max_bits // 2), max_bits // 2,
                                       levels[which])
                own = np.empty(len(fps), dtype=np.int64)
                own[i[home]] = leaf[home]
                meet = home | (leaf < own[i])
                i, leaf, home = i[meet], leaf[meet], home[meet]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), which), pa.int32()), pa.array(leaf, pa.int64()),
                     pa.array(fps[i], pa.int64()), pa.array(home)], schema=target)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        fps = np.ascontiguousarray(group["fp"].to_numpy()).view(np.uint64)
        a, b = shard_links(fps, group["home"].to_numpy(), int(group["tree"].iloc[0]), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = nodes.select("fp").mapInArrow(spread, ROUTED)
    return routed.groupBy("tree", "shard").applyInPandas(search, "a long, b long")


# ---------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for all nodes in links."""
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(),
                   "simhash-edges")
    labels = stored(edges.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")), "simhash-labels")
    while True:
        seen = (edges.join(labels, edges["b"] == labels["node"])
                .groupBy("a").agg(F.min("root").alias("m")))
        near = (labels.join(seen, labels["node"] == seen["a"])
                .select("node", "root", F.least("root", "m").alias("low")))
        up = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        after = stored(near.join(up, near["low"] == up["up"])
                       .select("node", F.col("root").alias("old"),
                               F.least("low", "top").alias("root")), "simhash-labels")
        forget(labels)
        labels = after.select("node", "root")
        if after.filter("root <> old").limit(1).count() == 0:
            forget(edges)
            return labels


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE,
                    sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest doc_id) of every document."""
    fps = stored(fingerprints(docs, size), "simhash-fps")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    links = stored(near_links(nodes, max_bits, sample), "simhash-links")
    roots = components(links)
    member = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "first", "root")
    smallest = member.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = member.join(smallest, "root").select(F.col("fp").alias("linked_fp"), "smallest")
    # written first: a join of two scans is one whose hot keys Spark can split
    named = stored(nodes.join(linked, nodes["fp"] == linked["linked_fp"], "left")
                   .select(F.col("fp").alias("named_fp"),
                           F.coalesce("smallest", "first").alias("component_id")), "simhash-named")
    forget(nodes, links, roots)
    return (fps.join(named, fps["fp"] == named["named_fp"])
            .select("doc_id", "fp", "component_id"))


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE,
               sample: int = SAMPLE) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id.

    Rows are told apart by id and text, so rows that share an id but not a
    component are decided each by itself. Rows without an id come last; ties go
    by a digest of the text, equal rows of a pair of id and text by a hash of
    all columns. Columns of any name pass through.

    Fingerprints, components and decisions are made on (id, digest, fingerprint)
    rows. Whole rows go one way at every size: those that a filter of fixed size
    over the keys in question doesn't know are kept where they are; the others
    (all losers, all repeated rows, and few more) are reduced to one row a key and
    meet the losing keys in an exact anti join.
    """
    own = docs.select(*_key(docs), F.col("text").cast("string").alias("text"))

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for none, doc_id, digest, text in rows:
            yield none, doc_id, digest, signed(fingerprint(text, size))

    found = stored(per_batch(own, "none boolean, doc_id long, digest binary, fp long", read),
                   "simhash-rows")
    rank = F.struct("none", "doc_id", "digest")
    nodes = stored(found.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-nodes")
    links = stored(near_links(nodes, max_bits, sample), "simhash-links")
    roots = components(links)
    linked = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "first", "root")
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    better = linked.join(best, "root").select(F.col("fp").alias("linked_fp"), "best")
    named = stored(nodes.join(better, nodes["fp"] == better["linked_fp"], "left")
                   .select(F.col("fp").alias("named_fp"), F.coalesce("best", "first").alias("best")),
                   "simhash-best")
    forget(nodes, links, roots)
    # an id and a text have one fingerprint, so all their rows win or none does
    gone = stored(found.join(named, found["fp"] == named["named_fp"])
                  .groupBy("none", "doc_id", "digest")
                  .agg(F.count(F.lit(1)).alias("n"), F.first(rank == F.col("best")).alias("wins"))
                  .filter("n > 1 or not wins"), "simhash-gone")
    forget(found, named)
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("row"), *_key(docs))
    marked = keyed.withColumn("known", _known(gone)(F.xxhash64("none", "doc_id", "digest")))
    sure = marked.filter(~F.col("known")).select("row.*")
    one = (marked.filter("known").groupBy("none", "doc_id", "digest")
           .agg(F.min_by("row", F.xxhash64("row")).alias("row")))
    losers = gone.filter("not wins").select("none", "doc_id", "digest")
    return sure.union(one.join(losers, ["none", "doc_id", "digest"], "left_anti").select("row.*"))


def _key(docs: DataFrame) -> list[Column]:
    """What tells rows apart: is the id null, the id (or 0), the text's digest."""
    doc_id = docs["doc_id"].cast("long")
    text = docs["text"].cast("string").cast("binary")
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest")]


def _places(h: Column) -> list[Column]:
    """Bits of a key's hash in the filter."""
    return [F.pmod(F.xxhash64(h, F.lit(k)), F.lit(GONE_BITS)) for k in range(GONE_PROBES)]


def _known(gone: DataFrame):
    """Tells for a key's hash (long) whether the key may be in ``gone``; a Bloom filter."""
    h = F.xxhash64("none", "doc_id", "digest")
    run = 1 << 16                                           # bits of a row to the driver
    rows = (gone.select(F.explode(F.array(*_places(h))).alias("at")).distinct()
            .groupBy(F.floor(F.col("at") / run).alias("part"))
            .agg(F.collect_list((F.col("at") % run).cast("int")).alias("at")))   # run at most

    def pack(got: Iterator[tuple]) -> Iterator[tuple]:
        for part, at in got:
            marks = np.zeros(run, dtype=np.uint8)
            marks[at] = 1
            yield part, np.packbits(marks, bitorder="little").tobytes()

    marks = np.zeros(GONE_BITS // 8, dtype=np.uint8)
    for r in per_batch(rows, "part long, bits binary", pack).collect():      # GONE_BITS in all
        marks[r["part"] * run // 8:(r["part"] + 1) * run // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = gone.sparkSession.sparkContext.broadcast(marks)

    @F.pandas_udf("boolean")
    def may(*places: pd.Series) -> pd.Series:
        hit = np.ones(len(places[0]), dtype=bool)
        for at in places:
            bit = at.to_numpy()
            hit &= shared.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
        return pd.Series(hit)

    return lambda key: may(*_places(key))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
